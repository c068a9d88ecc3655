"""Secret scans with a recursive decoding worklist (operator 4).

A text is the first layer of a worklist. Every layer is scanned with the same
patterns and then unwrapped: percent escapes, Unicode escapes, UTF-16, base64
runs (also over line ends) and gzip or zlib data inside escapes or base64 each
give a new layer, until no layer gives a new one (a layer seen before is not taken again, so cycles end). Each layer knows
for each of its characters the span of the original text that it came from, so
what is found inside is reported, and removed, in the original text.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import column, read, slices

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so shorter ones need no look
_ASSIGN_HINT = re.compile(r"passw|secret|token|api_?key", re.ASCII | re.IGNORECASE)

# an escape whose own first character is escaped, any number of times over, is decoded at once
_ONE_PERCENT = re.compile(r"%(?:25)*([0-9A-Fa-f]{2})")
_PERCENT = re.compile(r"(?:%(?:25)*[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\(?:x5[cC]|u005[cC]|U0000005[cC]|u\{0{0,4}5[cC]\})*"
                      r"(?:u\{([0-9A-Fa-f]{1,6})\}|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))"
                      r"|&(?:#0{0,5}38;|#[xX]0{0,4}26;)*(?:#([0-9]{1,7});|#[xX]([0-9A-Fa-f]{1,6});)")
#: single bytes of data written as text: percent escapes, with + as a space, or those of string literals
_BYTES = [re.compile(_UNICODE.pattern + r"|\\([abfnrtv0\\'\"])|%(?:25)*([0-9A-Fa-f]{2})" + more) for more in ("", r"|\+")]
_SIMPLE = dict(zip("abfnrtv0\\'\"", "\a\b\f\n\r\t\v\0\\'\""))
_LATIN = re.compile(r"[\x00-\xff]+")
_PACKED = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]")
#: packed bytes unpacked at a time; what comes before damaged data is kept
FEED = 256
#: UTF-16 of either byte order, of which each character was taken for two
_WIDE = re.compile(r"(?:[\x01-\xff]\x00){4,}|(?:\x00[\x01-\xff]){4,}")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
#: a line end, or its escape, between characters of base64
_WRAP = re.compile("(?:" + "|".join(f"{e}(?<=[A-Za-z0-9+/_-]{{4}}{e})" for e in (
    r"\n", r"\r\n", r"\r", r"\\r\\n", r"\\n", r"\\r")) + r")[\x20\t>]*(?=[A-Za-z0-9+/_-])")


def find(text: str) -> list[tuple[str, int, int]]:
    """Spans of one layer, leftmost non-overlapping for each kind."""
    out = [("hex", *m.span()) for m in _HEX.finditer(text)]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if _ASSIGN_HINT.search(text):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    return out


class Layer:
    """Decoded text whose runs map to spans of an earlier text.

    ``at[i]`` is where run ``i`` begins here; ``src[i]`` is (start, end, step,
    offset): with step 0 all of the run comes from the whole span, else
    character ``k`` of the span (``offset`` is that of the run's first) comes
    from ``start + k`` (step 1), from the two characters at ``start + 2 * k``
    (step 2), or base64 byte ``k`` from the characters that hold it (step 4).
    The map is joined to that of the parent, so that long chains stay cheap; it
    leads to the original text, or to the text of ``via``, a parent in pieces
    that bytes of more characters do not fit.
    """

    def __init__(self, text: str, at: list[int], src: list[tuple[int, int, int]], parent: "Layer | None"):
        self.text, self.at, self.via, self.first = text, at, parent, parent is None
        self.src = [(*s, 0) for s in src]
        if parent is not None and (joined := parent._joined(at, src)):
            (self.at, self.src), self.via = joined, parent.via

    def _joined(self, at: list[int], src: list[tuple[int, int, int]]) -> tuple[list, list] | None:
        """The map of a child, joined to this one, or None where it cannot be."""
        out_at, out_src = [], []
        for p, (a, b, step) in zip(at, src):
            if step == 0:
                out_at.append(p)
                out_src.append((self._one(a)[0], self._one(b - 1)[1], 0, 0))
                continue
            k = bisect_right(self.at, a) - 1
            start, end, mine, off = self.src[k]
            if step > 1:
                if mine != 1 or k + 1 < len(self.at) and self.at[k + 1] < b:
                    return None
                start += off + a - self.at[k]
                out_at.append(p)
                out_src.append((start, start + b - a, step, 0))
                continue
            while k < len(self.at) and self.at[k] < b:
                q = max(a, self.at[k])
                out_at.append(p + q - a)
                out_src.append((*self.src[k][:3], self.src[k][3] + q - self.at[k]))
                k += 1
        return out_at, out_src

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The span in the original text of ``start:end`` of this layer."""
        layer = self
        while layer is not None:
            start, end = layer._one(start)[0], layer._one(end - 1)[1]
            layer = layer.via
        return start, end

    def _one(self, i: int) -> tuple[int, int]:
        k = bisect_right(self.at, i) - 1
        a, b, step, off = self.src[k]
        if step == 0:
            return a, b
        off += i - self.at[k]
        if step == 1:
            return a + off, a + off + 1
        if step == 2:
            return a + 2 * off, a + 2 * off + 2
        return min(a + off * 8 // 6, b - 1), min(a + (off * 8 + 7) // 6 + 1, b)


def _replaced(layer: Layer, pattern, decode, how: int = 0) -> Layer | None:
    """The layer with every match decoded in place, so its surroundings stay."""
    text, parts, at, src, end, n = layer.text, [], [], [], 0, 0
    for m in pattern.finditer(text):
        for piece, a, b, step in ((text[end:m.start()], end, m.start(), 1), (decode(m), m.start(), m.end(), how)):
            if piece:
                parts.append(piece)
                at.append(n)
                src.append((a, b, step))
                n += len(piece)
        end = m.end()
    if not parts or end == 0:
        return None
    if end < len(text):
        parts.append(text[end:])
        at.append(n)
        src.append((end, len(text), 1))
    return Layer("".join(parts), at, src, layer)


def _percent(m) -> str:
    return bytes.fromhex("".join(_ONE_PERCENT.findall(m.group()))).decode("utf-8", "replace")


def _escape(m) -> str:
    hexed = m[1] or m[2] or m[3] or m[4] or m[6]
    code = int(hexed, 16) if hexed else int(m[5])
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd"


def _text(raw: bytes) -> tuple[str, bool]:
    """``raw`` as text, UTF-8 or else a character for each byte, and whether it is all readable UTF-8."""
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1"), False
    return text, all(c.isprintable() or c in "\r\n\t" for c in text)


def _inflated(raw: bytes, start: int) -> tuple[bytes, int]:
    """What the gzip or zlib data at ``start`` and all members after it unpack to, and where they end."""
    out, end = [], start
    while _PACKED.match(raw, end):
        z, at = zlib.decompressobj(47), end
        try:
            while not z.eof and at < len(raw):
                out.append(z.decompress(raw[at:at + FEED]))
                at += FEED
        except zlib.error:
            break
        end = min(at, len(raw)) - len(z.unused_data)
        while z.eof and raw[end:end + 1] == b"\0":  # padding between members
            end += 1
    return b"".join(out), end


def _unpacked(raw: bytes) -> list[tuple[bytes, int, int]]:
    """All that is packed in ``raw``, at any depth, with the bytes of ``raw`` that hold it."""
    out, work, met = [], [(raw, None)], set()
    while work:
        data, place = work.pop()
        if (key := hashlib.blake2b(data, digest_size=16).digest()) in met:
            continue  # data may unpack to themselves
        met.add(key)
        at = 0
        while m := _PACKED.search(data, at):
            more, end = _inflated(data, m.start())
            at = max(end, m.start() + 1) if more else m.start() + 1
            if more:
                out.append((more, *(place or (m.start(), max(end, m.start() + 1)))))
                work.append((more, out[-1][1:]))
    return out


def _byte(m) -> str:
    if m[7]:
        return _SIMPLE[m[7]]
    return chr(int(m[8], 16)) if m[8] else " " if m.group() == "+" else _escape(m)


def _escaped(layer: Layer, pattern) -> list[Layer]:
    """What is packed in data written as text with escapes, taken byte by byte."""
    if not (view := _replaced(layer, pattern, _byte)):
        return []
    return [Layer(_text(data)[0], [0], [(m.start() + a, m.start() + b, 0)], view)
            for m in _LATIN.finditer(view.text) for data, a, b in _unpacked(m.group().encode("latin-1"))]


def _base64(layer: Layer, m) -> list[Layer]:
    """What a run holds; where that is not readable from its start on, what it holds from the next three
    characters on too: one of the four is in step with any base64 that begins further on in the run."""
    out, (a, b) = [], m.span()
    chars = m.group().rstrip("=").replace("+", "-").replace("/", "_")
    for shift in range(4):
        body = chars[shift:len(chars) - ((len(chars) - shift) % 4 == 1)]  # six bits are no byte
        raw = base64.urlsafe_b64decode(body + "=" * (-len(body) % 4))
        text, readable = _text(raw)
        one = len(text) == len(raw)  # one byte for each character: exact places
        out.append(Layer(text, [0], [(a + shift, b, 4) if one else (a, b, 0)], layer))
        packed = _unpacked(raw)
        out += [Layer(_text(data)[0], [0], [(a, b, 0)], layer) for data, _, _ in packed]
        if readable or packed and packed[0][1:] == (0, len(raw)):
            break
    return out


def layers(text: str):
    """``text`` and everything that can be unwrapped from it, each once."""
    work, seen = [Layer(text, [0], [(0, len(text), 1)], None)], set()
    while work:
        layer = work.pop()
        key = hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        place = layer.back(0, len(layer.text)) if layer.text else (0, 0)
        if (key, place) in seen:
            continue
        seen.add((key, place))
        yield layer
        t = layer.text
        if "%" in t and (new := _replaced(layer, _PERCENT, _percent)):
            work.append(new)
        if ("\\" in t or "&#" in t) and (new := _replaced(layer, _UNICODE, _escape)):
            work.append(new)
        if "%" in t or "\\" in t or "&#" in t:
            for pattern in _BYTES[:1 + ("+" in t and "%" in t)]:
                work += _escaped(layer, pattern)
        if "\0" in t and (new := _replaced(layer, _WIDE, lambda m: m.group().replace("\0", ""), 2)):
            work.append(new)
        # base64 wrapped in lines is decoded with its line ends taken out; nothing else is looked for there
        for one in (layer, _replaced(layer, _WRAP, lambda m: "") if "\n" in t or "\r" in t or "\\" in t else None):
            work += [new for m in _BASE64.finditer(one.text) for new in _base64(one, m)] if one else []


def spans(text: str) -> tuple[list, list]:
    """Base spans of ``text`` and those of all layers, both sorted by start,
    then kind as listed, then end, each span once."""
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base: list = []
    every: set = set()
    for layer in layers(text):
        found = find(layer.text)
        if layer.first:
            base = sorted(found, key=order)
        every.update((kind, *layer.back(a, b)) for kind, a, b in found)
    return base, sorted(every, key=order)


def redact(text: str, found: list, mark: str = "[SECRET]") -> str:
    """``text`` with each union of overlapping spans replaced by ``mark``."""
    out, end = [], 0
    for _, a, b in found:
        if a >= end:
            out += [text[end:a], mark]
        end = max(end, b)
    return "".join([*out, text[end:]])


def scan(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """``doc_id[, text], base, spans`` for every row of ``docs(doc_id, text)``.

    ``base`` are the spans of the text itself, ``spans`` those of all layers in
    places of the text, as arrays of ``kind, start, end`` (code points, end
    exclusive); ``text`` is the text with its spans replaced. A null text
    counts as empty (and stays null in ``text``); empty texts have no spans;
    repeated rows give repeated results; other columns are not looked at; texts
    of any length are scanned whole.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    sql = "array<struct<kind:string,start:int,end:int>>"
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in slices(batches):
            clean, base, every = [], [], []
            for text in column(b, "text").to_pylist():
                one, found = spans(text) if text else ([], [])
                base.append([dict(zip(("kind", "start", "end"), s)) for s in one])
                every.append([dict(zip(("kind", "start", "end"), s)) for s in found])
                if with_text:
                    clean.append(redact(text, found) if found else text)
            cols = [column(b, "doc_id"), *([pa.array(clean, pa.string())] if with_text else []),
                    pa.array(base, kind), pa.array(every, kind)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *["text"] * with_text, "base", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, {'text string, ' * with_text}base {sql}, spans {sql}")


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs``, all rows and columns, with the secrets of ``text`` replaced by ``mark``."""
    def run(batches):
        for b in slices(batches):
            out = [redact(t, found, mark) if t and (found := spans(t)[1]) else t for t in column(b, "text").to_pylist()]
            at = b.schema.get_field_index("text")
            yield b.set_column(at, b.schema.field(at), pa.array(out, b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def _joined(c: str) -> F.Column:
    return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str) -> F.Column:
    return F.size(F.filter("base", lambda s: s["kind"] == F.lit(kind))).cast("long")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents"))
    counts = [_count(k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"),
                        _joined("spans").alias("spans"))


QUERIES = {"op4_secret_scan": op4_secret_scan}
ORACLE: dict[str, str] = {}
