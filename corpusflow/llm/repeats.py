"""Exact repeat removal by prefix-free parsing (operator 7).

A byte goes when a 50-byte string that covers it also starts in a document of
smaller id. Rolling-hash triggers parse every text into overlapping phrases:
of the 24-byte grams in a 50-byte window the one of least hash is the window's
trigger, and a phrase is what the consecutive windows of one trigger cover. So
equal windows have equal triggers wherever they are, and each lies in one
phrase of its document.

Documents lie in chunks by a hash of doc_id. Three rounds go from chunks to
shards and back:

1. each chunk sends its distinct trigger grams to shards by gram; a gram of
   one document only can be no part of a repeat; a bit for each says so;
2. each chunk sends hashes of its dictionary, the distinct phrases with the
   other triggers, with the smallest doc_id that has them. A phrase that a
   smaller document of another chunk has goes whole. Of the others a phrase is
   asked for if its trigger stands in a second phrase;
3. these are sent, each by the one chunk of its smallest doc_id. A shard sorts
   the suffixes of its phrases (their windows, cut at 50 bytes) into one order,
   in which equal windows are neighbours; a bit for each window says whether a
   smaller document has it. The chunk applies what came back to its parse, the
   sequence of phrases of each document.

Whole copies of a text are told by hash before and take no part in the rounds.
Whatever many documents share is sent once by each chunk, so hot passages do
not gather. A gram that stands before very many different contexts is too much
for one shard; the hashes of its phrases are sent window by window, to shards by
the whole window, which then need not be asked for. Texts are parsed and moved
once, into a table bucketed by chunk that all rounds read in place. Chunks and
shards have so many bytes of text each, and are held as arrays.
"""

from __future__ import annotations

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import column, mix64, read, scratch, slices, written

WIDTH = 50
GRAM = 24
#: text bytes that a chunk should not exceed (a longer text is a chunk's whole)
CHUNK_BYTES = 16 << 20
#: text bytes whose phrases a shard should not exceed, and for fewer of which there is no further shard
SHARD_BYTES, LEAST_BYTES = 8 << 20, 1 << 20
#: a gram's phrases, counted by chunk, are sent window by window from the square of this on
HOT_CHUNKS = 128
#: windows that a shard sorts at a time
SORT_WINDOWS = 200_000
#: windows that are parsed at a time, and pieces that are handled at a time
BLOCK, PIECES = 1 << 18, 1 << 15

_BASE = 0x9E3779B97F4A7C15
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))


def _grams(raw: np.ndarray) -> np.ndarray:
    """Hashes of the 24-byte grams: polynomial hashes of 8 and 16 bytes joined, mixed."""
    h, n, of = _BYTE[raw], 1, {}
    while n <= GRAM // 2:
        h = h[:-n] * np.uint64(pow(_BASE, n, 1 << 64)) + h[n:]
        n *= 2
        of[n] = h
    return mix64(of[16][:-8] * np.uint64(pow(_BASE, 8, 1 << 64)) + of[8][16:])


def _triggers(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each phrase of ``text`` the trigger gram's hash and place, and the first window."""
    raw, wide = np.frombuffer(text, np.uint8), WIDTH - GRAM + 1
    grams, at, first = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for begin in range(0, len(text) - WIDTH + 1, BLOCK):
        g = _grams(raw[begin:begin + BLOCK + WIDTH - 1])
        low = (g & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(g), dtype=np.uint64)
        n = 1
        while 2 * n <= wide:
            low = np.minimum(low[:-n], low[n:])
            n *= 2
        if wide > n:
            low = np.minimum(low[:len(low) - (wide - n)], low[wide - n:])
        place = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        if begin and place[0] + begin == at[-1][-1]:  # goes on
            new = new[1:]
        grams.append(g[place[new]])
        at.append(place[new] + begin)
        first.append(new + begin)
    return np.concatenate(grams), np.concatenate(at), np.concatenate(first)


def parse(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The phrases of ``text``: trigger gram hash, first and last window start."""
    g, _, first = _triggers(text)
    return g, first, np.append(first[1:], len(text) - WIDTH + 1)[:len(first)] - 1


def marks(text: bytes) -> bytes:
    """The parse of ``text``, a byte a phrase: how far its trigger is behind the one
    before, and whether it is the trigger from when it came into the window, or
    from when the one before left it."""
    _, at, first = _triggers(text)
    came = np.append(False, first[1:] != at[:-1] + 1)[:len(at)]
    return (2 * np.diff(at, prepend=0) + came).astype(np.uint8).tobytes()


def phrases(marked: np.ndarray, count: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigger place, first and last window of the phrases of texts that stand at
    ``start`` in a buffer; ``marked`` has the marks of all, ``count`` how many of each."""
    step = (marked >> 1).astype(np.int64)
    start, size, count = start[count > 0], size[count > 0], count[count > 0]
    head = np.cumsum(count) - count
    at = np.cumsum(step)
    at += np.repeat(start - at[head] + step[head], count)
    first = np.where(marked & 1, at - (WIDTH - GRAM), np.append(0, at)[:len(at)] + 1)
    first[head] = start
    last = np.append(first[1:], 0)[:len(at)] - 1
    last[head + count - 1] = start + size - WIDTH
    return at, first, last


def _blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def _planes(a: np.ndarray) -> bytes:
    """Whole numbers byte by byte, so that equal upper bytes stand together."""
    return _blob(a.astype(np.int64).view(np.uint8).reshape(-1, 8).T)


def _unplanes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _bits(a: np.ndarray) -> bytes:
    return np.packbits(a).tobytes()


def _flags(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def _binary(values) -> pa.Array:
    return pa.array(values, pa.binary())


def _cut(a: np.ndarray, sizes) -> list[np.ndarray]:
    return np.split(a, np.cumsum(sizes)[:-1]) if len(sizes) else []


def _groups(keys: np.ndarray) -> np.ndarray:
    """Where in sorted keys each begins."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)


def _digests(text: bytes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of ``text[a:b]``, many at a time."""
    from xxhash import xxh3_64_intdigest as digest
    view, out = memoryview(text), np.empty(len(a), np.uint64)
    for k in range(0, len(a), PIECES):
        x, y = a[k:k + PIECES].tolist(), b[k:k + PIECES].tolist()
        out[k:k + len(x)] = np.fromiter((digest(view[i:j]) for i, j in zip(x, y)), np.uint64, len(x))
    return out


class Chunk:
    """The documents of a chunk and what came back to it.

    Texts stand in one buffer with a byte between them. A key is a shard's
    number and 32 bits of a hash, which tell a shard's keys apart but for a few;
    those are then looked at with others'. Answers are given in the order in
    which the chunk asked: by shard, then by key of a gram or hash of a phrase,
    which does not depend on the order of rows.
    """

    def __init__(self, table: pa.Table, answers: pa.Table, shards: int):
        import xxhash
        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress
        self.shards, self.number = shards, table["chunk"][0].as_py() if len(table) else None
        self.answers = sorted((r for r in answers.to_pylist() if r["shard"] is not None), key=lambda r: r["shard"])
        copies = {tuple(x) for x in zip(answers["doc_id"].to_pylist(), answers["hash"].to_pylist()) if x[1] is not None}
        self.ids, texts, marked = table["doc_id"].to_pylist(), [], []
        self.copy = []  # whether it is a copy of a smaller document
        for d, z, m in zip(self.ids, table["packed"].to_pylist(), table["marks"].to_pylist()):
            texts.append(unpack(z))
            h = xxhash.xxh64_intdigest(texts[-1], 42) if copies else 0
            self.copy.append((d, h - (h >> 63 << 64)) in copies)
            # the parse of those that take part: with an id, long enough, no copies
            marked.append(b"" if d is None or self.copy[-1] else unpack(m))
        self.size = np.array([len(t) for t in texts], np.int64)
        self.start = np.cumsum(self.size + 1) - self.size - 1
        self.text = b"\0".join(texts)
        count = np.array([len(m) for m in marked], np.int64)
        at, self.first, self.last = phrases(np.frombuffer(b"".join(marked), np.uint8), count, self.start, self.size)
        self.doc = np.repeat(np.array([d or 0 for d in self.ids], np.int64), count)
        self.key = self._keys(at)

    def _keyed(self, to_shard: np.ndarray, low: np.ndarray) -> np.ndarray:
        return (mix64(to_shard) % np.uint64(self.shards)) << np.uint64(32) | low & np.uint64(0xFFFFFFFF)

    def _keys(self, at: np.ndarray) -> np.ndarray:
        """The keys of the grams at these places."""
        raw, out = np.frombuffer(self.text, np.uint8), np.empty(len(at), np.uint64)
        for k in range(0, len(at), PIECES):
            words = raw[at[k:k + PIECES, None] + np.arange(GRAM)].view(np.uint64)
            h = np.full(len(words), _BASE, np.uint64)
            for w in range(GRAM // 8):
                h = mix64(h ^ words[:, w]) * np.uint64(_BASE)
            out[k:k + len(h)] = self._keyed(h, h)
        return out

    def _told(self, what: str, shard: np.ndarray, bits: np.ndarray | None = None) -> np.ndarray:
        """The answers to what was asked of these shards (in order), ``bits`` of each."""
        bits = np.ones(len(shard), np.int64) if bits is None else bits
        head = _groups(shard)
        blobs = {r["shard"]: r[what] for r in self.answers if r[what] is not None}
        return np.concatenate([np.empty(0, bool), *(_flags(blobs[int(p)], int(n)) for p, n in zip(shard[head], np.add.reduceat(bits, head) if len(head) else ()))])

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct keys of trigger grams, whether several documents have them, and in how many phrases."""
        order = np.argsort(self.key)
        key, doc = self.key[order], self.doc[order]
        head = _groups(key)
        many = np.diff(np.append(head, len(key)))
        twice = np.minimum.reduceat(doc, head) != np.maximum.reduceat(doc, head) if len(head) else np.empty(0, bool)
        # of those that stand in several places the different phrases are counted
        some = order[np.repeat(many > 1, many)]
        owner = np.repeat(np.arange(len(head)), many)[np.repeat(many > 1, many)]
        if len(some):
            pid = _digests(self.text, self.first[some], self.last[some] + WIDTH)
            by = np.argsort(pid)  # equal phrases have equal grams
            many = np.where(many > 1, np.bincount(owner[by][_groups(pid[by])], minlength=len(head)), many)
        return key[head], twice, many

    def look(self) -> None:
        """What is looked at: phrases whose grams other documents have too, the
        single windows of hot ones, and the dictionary, these once each."""
        key, flag = np.unique(self.key, return_inverse=True)
        shard = (key >> np.uint64(32)).astype(np.int64)
        cold, hot = (np.flatnonzero(self._told(x, shard)[flag]) for x in ("shared", "hot"))
        del key, flag, shard
        windows = self.last[hot] - self.first[hot] + 1
        of = np.repeat(hot, windows)
        single = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows - self.first[hot], windows)
        self.a, self.b = np.concatenate((self.first[cold], single)), np.concatenate((self.last[cold], single))
        del single
        pid, self.whose = _digests(self.text, self.a, self.b + WIDTH), np.concatenate((self.doc[cold], self.doc[of]))
        h = pid[len(cold):]
        keys = np.concatenate((self.key[cold], self._keyed(h, mix64(h ^ self.key[of]))))
        del of, h, cold
        order = np.argsort(pid)  # equal pieces have equal keys
        head = _groups(pid[order])
        least = np.minimum.reduceat(self.whose[order], head) if len(head) else np.empty(0, np.int64)
        one = order[head]
        keys, pid = keys[one], pid[one]
        by = np.argsort(keys >> np.uint64(32), kind="stable")
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.repeat(rank, np.diff(np.append(head, len(order))))
        self.one, self.keys, self.pids, self.least = one[by], keys[by], pid[by], least[by]
        self.shard = (self.keys >> np.uint64(32)).astype(np.int64)

    def asked(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the dictionary what goes whole, and the places of what is asked for."""
        return self._told("gone", self.shard), np.flatnonzero(self._told("ask", self.shard))

    def rows(self, shard: np.ndarray, **columns) -> pa.Table:
        """A row for each shard; columns: arrays in order of shards, and how their parts are written."""
        head = _groups(shard)
        n = np.diff(np.append(head, len(shard)))
        return pa.table({"shard": pa.array(shard[head], pa.int32()), "chunk": pa.array([self.number] * len(head), pa.int32())}
                        | {c: _binary([how(x) for x in _cut(a, n)]) for c, (a, how) in columns.items()})


def _round_one(shards: int):
    """Chunk -> its distinct trigger grams, by shard; ``twice``: in several of its documents."""
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        c = Chunk(table, answers, shards)
        key, twice, many = c.grams()
        return c.rows((key >> np.uint64(32)).astype(np.int64), grams=(key.astype(np.uint32), _blob), twice=(twice, _bits),
                      many=(np.minimum(many, 0xFFFF).astype(np.uint16), _blob))
    return run


def _column(shard: pa.Table, name: str, dtype) -> tuple[np.ndarray, list[int]]:
    """The values of all rows, and how many each has."""
    each = [np.frombuffer(b, dtype) for b in shard[name].to_pylist()]
    return np.concatenate(each), [len(x) for x in each]


def _repeated(hot_chunks: int):
    """Shard -> for each chunk a bit for each of its grams: in several documents, and hot."""
    def run(shard: pa.Table) -> pa.Table:
        grams, n = _column(shard, "grams", np.uint32)
        _, inverse, count = np.unique(grams, return_inverse=True, return_counts=True)
        many = count > 1
        many[inverse[np.concatenate([_flags(b, k) for b, k in zip(shard["twice"].to_pylist(), n)])]] = True
        hot = many & (np.bincount(inverse, _column(shard, "many", np.uint16)[0]) >= hot_chunks ** 2)
        return pa.table({"chunk": shard["chunk"], "shard": shard["shard"],
                         "shared": _binary([_bits(x) for x in _cut((many & ~hot)[inverse], n)]),
                         "hot": _binary([_bits(x) for x in _cut(hot[inverse], n)])})
    return run


def _round_two(shards: int):
    """Chunk -> hashes of its dictionary: each looked-at piece once with its smallest doc_id, by shard."""
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        c = Chunk(table, answers, shards)
        c.look()
        return c.rows(c.shard, key=(c.keys.astype(np.uint32), _blob), pid=(c.pids, _blob), least=(c.least, _planes))
    return run


def _first_of(shard: pa.Table) -> pa.Table:
    """Shard -> for each chunk two bits for each of its pieces: a smaller document of
    another chunk has it; the piece is needed, as others have its key."""
    key, n = _column(shard, "key", np.uint32)
    pid, _ = _column(shard, "pid", np.uint64)
    least = np.concatenate([_unplanes(b) for b in shard["least"].to_pylist()])
    order = np.lexsort((least, pid, key))
    k, p = key[order], pid[order]
    one = order[np.append(True, (k[1:] != k[:-1]) | (p[1:] != p[:-1]))[:len(k)]]
    same = key[one][1:] == key[one][:-1]
    gone, ask = np.ones(len(key), bool), np.zeros(len(key), bool)
    gone[one] = False
    ask[one] = np.append(same, False) | np.append(False, same)
    return pa.table({"chunk": shard["chunk"], "shard": shard["shard"],
                     "gone": _binary([_bits(x) for x in _cut(gone, n)]), "ask": _binary([_bits(x) for x in _cut(ask, n)])})


def _round_three(shards: int):
    """Chunk -> the pieces it was asked for, by shard."""
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        c = Chunk(table, answers, shards)
        c.look()
        _, ask = c.asked()
        a, z = c.a[c.one[ask]], c.b[c.one[ask]] + WIDTH
        body = lambda of: b"".join([c.text[i:j] for i, j in of.tolist()])
        return c.rows(c.shard[ask], key=(c.keys[ask].astype(np.uint32), _blob), least=(c.least[ask], _planes),
                      size=((z - a).astype(np.uint8), _blob), body=(np.stack((a, z), 1), body))
    return run


def _smaller(body, start, windows, least) -> np.ndarray:
    """Of each window of the phrases whether one of smaller ``least`` has it: their
    suffixes in one order, equal windows side by side."""
    owner = np.repeat(np.arange(len(start)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    text = np.ascontiguousarray(body[(start[owner] + offset)[:, None] + np.arange(WIDTH)]).view(f"S{WIDTH}").ravel()
    mine = least[owner]
    by = np.lexsort((mine, text))
    text, mine = text[by], mine[by]
    first = np.append(True, text[1:] != text[:-1])
    out = np.empty(len(owner), bool)
    out[by] = mine[np.flatnonzero(first)[np.cumsum(first) - 1]] < mine
    return out


def _sorted_shard(sort_windows: int):
    """Shard -> for each chunk a bit for each window of its pieces: a smaller document has it."""
    def run(shard: pa.Table) -> pa.Table:
        key, n = _column(shard, "key", np.uint32)
        size = _column(shard, "size", np.uint8)[0].astype(np.int64)
        least = np.concatenate([_unplanes(b) for b in shard["least"].to_pylist()])
        body = np.frombuffer(b"".join(shard["body"].to_pylist()), np.uint8)
        start, windows = np.cumsum(size) - size, size - WIDTH + 1
        at = np.cumsum(windows) - windows
        found = np.empty(windows.sum(), bool)
        order = np.argsort(key, kind="stable")
        border = np.append(_groups(key[order])[1:], len(order))  # where the triggers end
        done = np.append(0, np.cumsum(windows[order]))
        a = 0
        while a < len(order):  # some triggers at a time, never part of one
            over = np.searchsorted(done[border], done[a] + sort_windows, side="right") - 1
            b = int(border[max(over, np.searchsorted(border, a, side="right"))])
            m = order[a:b]
            w = windows[m]
            found[np.repeat(at[m], w) + np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)] = _smaller(body, start[m], w, least[m])
            a = b
        each = [int(x.sum()) for x in _cut(windows, n)]
        return pa.table({"chunk": shard["chunk"], "shard": shard["shard"], "windows": _binary([_bits(x) for x in _cut(found, each)])})
    return run


def _removed(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends in the chunk's buffer of the maximal runs that go, whole copies apart."""
    c.look()
    gone, ask = c.asked()
    windows = c.b[c.one] - c.a[c.one] + 1
    bits = c._told("windows", c.shard[ask], windows[ask])
    # a whole piece goes where a smaller document has it, of this chunk or another
    whole = gone[c.entry] | (c.whose > c.least[c.entry])
    step = np.zeros(len(c.text) + 2, np.int8)
    step[c.a[whole]] += 1  # pieces share no window
    step[c.b[whole] + 1] -= 1
    mask = np.cumsum(step, dtype=np.int8).astype(bool)
    del step
    # else the windows that smaller documents have
    place = np.full(len(c.one), -1)
    place[ask] = np.cumsum(windows[ask]) - windows[ask]
    part = np.flatnonzero(~whole & (place[c.entry] >= 0))
    for k in range(0, len(part), PIECES):
        some = part[k:k + PIECES]
        n = windows[c.entry[some]]
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hit = bits[np.repeat(place[c.entry[some]], n) + offset]
        mask[(np.repeat(c.a[some], n) + offset)[hit]] = True
    edge = np.flatnonzero(np.diff(mask.view(np.int8), prepend=np.int8(0)))  # the last place is no window
    begin, end = edge[::2], edge[1::2] + WIDTH - 1
    new = np.append(True, begin[1:] > end[:-1])[:len(begin)]
    return begin[new], end[np.append(new[1:], True)[:len(end)]]


def _apply(shards: int, with_kept: bool):
    """Chunk and what came back -> the result rows of its documents."""
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        c = Chunk(table, answers, shards)
        begin, end = _removed(c)
        cut = np.searchsorted(begin, np.append(c.start, len(c.text) + 1))
        spans, sha, kept = [], [], []
        for k, (copy, n, at) in enumerate(zip(c.copy, c.size.tolist(), c.start.tolist())):
            i, j = cut[k], cut[k + 1]
            spans.append([0, n] if copy else (np.stack((begin[i:j], end[i:j]), 1).ravel() - at).tolist() if j > i else [])
            edges = [0, *spans[-1], n]
            rest = b"".join([c.text[at + x:at + y] for x, y in zip(edges[::2], edges[1::2])])
            sha.append(hashlib.sha256(rest).hexdigest())
            if with_kept:
                kept.append(rest)
        out = {"doc_id": table["doc_id"], "n_bytes": pa.array(c.size, pa.int64()),
               "n_removed": pa.array([sum(s[1::2]) - sum(s[::2]) for s in spans], pa.int64()),
               "spans": pa.array(spans, pa.list_(pa.int64())), "kept_sha256": pa.array(sha, pa.string())}
        return pa.table(out | ({"kept": _binary(kept)} if with_kept else {}))
    return run


def _packed(batches):
    """Texts parsed and compressed one by one, before they are moved."""
    import zstandard
    pack, quick = zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdCompressor(level=1).compress
    for b in slices(batches):
        texts = column(b, "text").to_pylist()
        yield pa.RecordBatch.from_arrays([column(b, "chunk"), column(b, "doc_id"), _binary([pack(t) for t in texts]), _binary([quick(marks(t)) for t in texts])],
                                         names=["chunk", "doc_id", "packed", "marks"])


def remove_repeats(docs: DataFrame, with_kept: bool = False, hot_chunks: int = HOT_CHUNKS,
                   sort_windows: int = SORT_WINDOWS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept_sha256[, kept]`` for every row of ``docs(doc_id, text)``.

    Texts are UTF-8 bytes; ``spans`` are the maximal removed runs as start,
    end, ... and ``kept`` the remaining bytes (which may cut characters). Null
    texts count as empty; texts of fewer than 50 bytes lose nothing; a row
    without doc_id loses nothing and takes nothing from others; rows that
    repeat a doc_id are the same document, so neither takes from the other.
    Other columns are not looked at. ``hot_chunks`` and ``sort_windows`` do not
    change the result.
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(3 * n, math.ceil(size / CHUNK_BYTES))
    shards = max(1, math.ceil(size / SHARD_BYTES), min(n, math.ceil(size / LEAST_BYTES)))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(chunks)).cast("int"))

    # whole copies: a text's documents but the one of smallest id
    hashes = written(rows.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= WIDTH)).select(
        "chunk", "doc_id", F.xxhash64("text").alias("hash"), F.xxhash64(F.lit(1), "text").alias("hash2")), "repeats-hashes")
    first = hashes.groupBy("hash", "hash2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies = written(hashes.join(first, ["hash", "hash2"]).where("doc_id > first").select("chunk", "doc_id", "hash"), "repeats-copies")

    name = f"llm_repeats_{uuid.uuid4().hex}"
    (rows.mapInArrow(_packed, "chunk int, doc_id long, packed binary, marks binary").repartition(n, "chunk")
     .write.format("parquet").bucketBy(n, "chunk").sortBy("chunk").option("compression", "none")
     .option("path", scratch(spark, "repeats")).saveAsTable(name))
    table = spark.table(name).select("chunk", "doc_id", "packed", "marks").groupBy("chunk")

    def answers(*tables: DataFrame):
        """What came back to the chunks, as one table."""
        every = spark.createDataFrame([], "chunk int, doc_id long, hash long, shard int, shared binary, hot binary, gone binary, ask binary, windows binary")
        for t in tables:
            every = every.unionByName(t, allowMissingColumns=True)
        return every.groupBy("chunk")

    sent = table.cogroup(answers(copies)).applyInArrow(_round_one(shards), "shard int, chunk int, grams binary, twice binary, many binary")
    shared = written(sent.groupBy("shard").applyInArrow(_repeated(hot_chunks), "chunk int, shard int, shared binary, hot binary"), "repeats-grams")
    pieces = table.cogroup(answers(copies, shared)).applyInArrow(_round_two(shards), "shard int, chunk int, key binary, pid binary, least binary")
    told = written(pieces.groupBy("shard").applyInArrow(_first_of, "chunk int, shard int, gone binary, ask binary"), "repeats-pieces")
    bodies = table.cogroup(answers(copies, shared, told)).applyInArrow(
        _round_three(shards), "shard int, chunk int, key binary, least binary, size binary, body binary")
    found = bodies.groupBy("shard").applyInArrow(_sorted_shard(sort_windows), "chunk int, shard int, windows binary")
    return table.cogroup(answers(copies, shared, told, found)).applyInArrow(
        _apply(shards, with_kept), "doc_id long, n_bytes long, n_removed long, spans array<long>, kept_sha256 string"
                                   + ", kept binary" * with_kept)


def op7_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.floor(F.size("spans") / 2).alias("n_spans"), "kept_sha256")


QUERIES = {"op7_repeat_removal": op7_repeat_removal}
ORACLE = {"op7_repeat_removal": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM d, LATERAL (SELECT unnest(range(0, d.n - 49)) AS i)),
f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
r AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM w JOIN f USING (s) WHERE least < doc_id),
g AS (SELECT doc_id, i, sum(CASE WHEN gap IS NULL OR gap > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM r),
sp AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, k),
e AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS was FROM sp),
p AS (SELECT e.doc_id, string_agg(substr(h, 2 * was + 1, 2 * (a - was)), '' ORDER BY a) AS x, max(b) AS fin,
        sum(b - a) AS n_removed, count(*) AS n_spans FROM e JOIN d USING (doc_id) GROUP BY e.doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(x, '') || substr(h, 2 * coalesce(fin, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN p USING (doc_id)
"""}
