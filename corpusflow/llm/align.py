"""Cross-tokenizer alignment by pointer jumping (operator 12).

Two tokenizers tile the same bytes. Every token points to the farthest-right
token of the other tokenizer that it overlaps: the one that holds its last
byte, or itself if nothing reaches beyond its end. Successor doubling
(``next = next[next]``, vectorised over all tokens of a batch) ends when every
token points to the terminal token of its component; tokens of one terminal
are one group.

A space or line end between two characters that are no white space begins a
token in both tokenizers, so a text is cut there: its units are tokenized and
aligned once for as long as a Python worker keeps them, and a text's result is
put together from its units. One pass writes each text's figures and the id
pairs of its links, and adds up the links by unit in each task, then by id pair
across the corpus. A second pass over the written id pairs looks up each link's
count. The table of id pairs is broadcast while it has at most ``pairs_kept``
rows (it is counted first), and joined by id pair otherwise.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import column, read, slices, utf8, written
from corpusflow.llm.tokens import byte_symbols

#: id pairs (16 bytes each) that are broadcast at most
PAIRS_KEPT = 1 << 22
#: words and their characters kept in one Python worker; the table starts anew beyond
WORDS_KEPT = 400_000
CHARS_KEPT = 1 << 24
#: times that a word is met at least if it stays when the table starts anew
OFTEN = 4
#: characters of text that are cut into words at a time
BLOCK = 1 << 20
#: white space of either tokenizer's reading, and the mark for a space
SPACE = "\\s\\x1c-\\x1f\\u2581"
CUT = re.compile(f"(?<=[^{SPACE}])(?=[ \n][^{SPACE}])")
#: what lies between a space and a cut, or begins with a line end
PLAIN = re.compile(f"\n?[^{SPACE}](?:.*[^{SPACE}])?", re.DOTALL).fullmatch


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each A token and each B token, from the byte offsets at
    which the tokens of two tilings of the same bytes end."""
    n = len(ends_a)
    # the token of the other side that holds a token's last byte
    from_a = np.searchsorted(ends_b, ends_a)
    from_b = np.searchsorted(ends_a, ends_b)
    own = np.arange(len(ends_b)) + n
    follow = np.concatenate([from_a + n, np.where(ends_a[from_b] == ends_b, own, from_b)])
    while True:
        doubled = follow[follow]
        if np.array_equal(doubled, follow):
            break
        follow = doubled
    # terminals are B tokens that point to themselves; their order is that of the bytes
    label = (np.cumsum(follow[n:] == own) - 1)[follow - n]
    return label[:n], label[n:]


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlapping pairs: places of their A and B tokens, and where their
    overlap ends. Both sides tile the bytes, so each stretch between
    neighbouring ends is the overlap of one pair."""
    cuts = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
    cuts = cuts[np.append(cuts[1:] != cuts[:-1], True)]
    return np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts), cuts


def _ranges(ptr: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places of the entries of rows ``ids`` in a table with row borders ``ptr``."""
    size = ptr[ids + 1] - ptr[ids]
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(ptr[ids] - (ends - size), size)


class Words:
    """Units of text with their tokens, groups and links under both tokenizers."""

    def __init__(self, json_file: bytes, model_file: bytes):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(json_file.decode())
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_file)
        byte_of = {c: bytes([i]) for i, c in enumerate(byte_symbols())}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = b"".join(byte_of[c] if c in byte_of else c.encode() for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # a piece with a space or line end behind another character could cross a cut
        self.cuts = "▁" in pieces and not any(re.search("[^▁]▁|\n", p) for p in pieces)
        #: do id pairs fit in 32 bits?
        self.narrow = len(self.bytes_a) * len(self.bytes_b) <= 1 << 32
        self.len_a, self.len_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        # an id with the mark behind it: , within a side, | between the sides, ; between groups
        self.marked = [[np.array([f"{i}{mark}" for i in range(len(x))], object) for mark in (",", end)]
                       for x, end in ((self.bytes_a, "|"), (self.bytes_b, ";"))]
        self.chars_a, self.chars_b = (np.array([len(t) for t in m[0]], np.int64) for m in self.marked)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.strings: list[str] = []
        self.uses = np.zeros(0, np.int64)
        #: tokens of A, tokens of B, groups, links of each word; all 0 where the tokens do not make up its bytes
        self.sizes = np.zeros((0, 4), np.int64)
        self.same = np.zeros(0, bool)
        self.ptr = np.zeros(1, np.int64)
        #: A's id times B's number of ids, plus B's id, of each link
        self.pairs = np.zeros(0, np.int64)

    def full(self) -> bool:
        return len(self.index) > WORDS_KEPT or self.chars > CHARS_KEPT

    def shrink(self) -> None:
        """Make room: only words met often stay, under new numbers, if they are few."""
        often = np.flatnonzero(self.uses >= OFTEN)
        names, old = list(self.index), (self.strings, self.sizes, self.same, self.ptr, self.pairs)
        names = [names[i] for i in often.tolist()]
        chars = sum(map(len, names))
        self.clear()
        if 2 * len(names) > WORDS_KEPT or 2 * chars > CHARS_KEPT:
            return
        self.index, self.chars = dict(zip(names, range(len(names)))), chars
        self.uses = np.zeros(len(names), np.int64)
        strings, sizes, same, ptr, pairs = old
        self.strings = [strings[i] for i in often.tolist()]
        self.sizes, self.same, self.pairs = sizes[often], same[often], pairs[_ranges(ptr, often)]
        self.ptr = np.concatenate([[0], np.cumsum(sizes[often, 3])])

    def blocks(self, text: str):
        """A space and the text, cut where units are into about ``BLOCK`` characters."""
        text, at = " " + text, 0
        while self.cuts and len(text) - at > BLOCK and (m := CUT.search(text, at + BLOCK)):
            yield text[at:m.start()]
            at = m.start()
        yield text[at:]

    def units(self, block: str) -> tuple[list[str], set[str]]:
        """The units of a block, and those not yet in the table. A plain unit is
        written without the space that it begins with; others begin with a space
        or line end."""
        out = block[1:].replace("\n", " \n").split(" ")
        if block[0] == "\n":
            out[0] = "\n" + out[0]
        new = set(out).difference(self.index)
        if not all(map(PLAIN, new)):
            parts = CUT.split(block) if self.cuts else [block]
            out = [x[1:] if x[0] == " " and x[1:2] != "\n" and PLAIN(x, 1) else x for x in parts]
            new = set(out).difference(self.index)
        return out, new

    def learn(self, new: list[str]) -> None:
        """Tokenize and align units that are not in the table."""
        if not new:
            return
        whole = [w if w[0] in " \n" else " " + w for w in new]
        ids_a = [x.ids for x in self.a.encode_batch_fast(whole, add_special_tokens=False)]
        # the model adds the space that a unit begins with; before a line end it is a token of its own
        ids_b = self.b.encode([w if w[0] == "\n" else w[1:] for w in whole], num_threads=1)
        ids_b = [x[1:] if w[0] == "\n" else x for x, w in zip(ids_b, whole)]
        want = [w.encode() for w in whole]
        flat_a, flat_b = (list(chain.from_iterable(ids)) for ids in (ids_a, ids_b))
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b))
        a, b = np.array(flat_a, np.int64), np.array(flat_b, np.int64)
        same = self._same(want, (flat_a, a, n_a, self.bytes_a, self.len_a), (flat_b, b, n_b, self.bytes_b, self.len_b))
        good = np.flatnonzero(same)
        if len(good) < len(new):
            a, b, n_a, n_b = a[np.repeat(same, n_a)], b[np.repeat(same, n_b)], n_a[good], n_b[good]
        sizes = np.zeros((len(new), 4), np.int64)
        strings, pairs = [""] * len(new), np.zeros(0, np.int64)
        if len(good):
            ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
            group_a, group_b = groups(ends_a, ends_b)
            at_a, at_b, cuts = links(ends_a, ends_b)
            pairs = a[at_a] * len(self.bytes_b) + b[at_b]
            stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
            upto = np.searchsorted(cuts, ends_a[stop_a - 1], "right")
            sizes[good] = np.stack([n_a, n_b, np.diff(group_b[stop_b - 1] + 1, prepend=0), np.diff(upto, prepend=0)], axis=1)
            order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
            marked = np.concatenate([np.where(np.append(g[1:] == g[:-1], False), m[0][x], m[1][x])
                                     for g, m, x in zip((group_a, group_b), self.marked, (a, b))])[order]
            chars = np.cumsum(np.concatenate([self.chars_a[a], self.chars_b[b]])[order])
            text, stop = "".join(marked.tolist()), chars[stop_a + stop_b - 1].tolist()
            for i, s, e in zip(good.tolist(), [0, *stop], stop):
                strings[i] = text[s:e - 1]
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        self.chars += sum(map(len, new))
        self.strings += strings
        self.sizes = np.concatenate([self.sizes, sizes])
        self.same = np.concatenate([self.same, same])
        self.ptr = np.concatenate([self.ptr, self.ptr[-1] + np.cumsum(sizes[:, 3])])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])

    @staticmethod
    def _same(want: list[bytes], *sides) -> np.ndarray:
        """Do both sides' tokens make up each unit byte for byte?"""
        whole, size = b"".join(want), np.fromiter(map(len, want), np.int64, len(want))
        same = np.ones(len(want), bool)
        for flat, ids, n, of, lens in sides:
            stop = np.cumsum(n)
            upto = np.concatenate([[0], np.cumsum(lens[ids])])[np.concatenate([[0], stop])]
            if not np.array_equal(np.diff(upto), size) or b"".join(map(of.__getitem__, flat)) != whole:
                same &= [b"".join(map(of.__getitem__, flat[i:j])) == w for i, j, w in zip([0, *stop.tolist()], stop.tolist(), want)]
        return same

    def placed(self, texts: list[str]):
        """``(i, ids)`` for each block of each text: the numbers of its words.
        Numbers hold until ``shrink`` is called."""
        waiting, size = [], 0
        for i, text in enumerate(texts):
            for block in self.blocks(text):
                waiting.append((i, *self.units(block)))
                size += len(block)
                if size >= BLOCK:
                    yield from self._numbered(waiting)
                    waiting, size = [], 0
        yield from self._numbered(waiting)

    def _numbered(self, waiting):
        if not waiting:
            return
        self.learn(list(set().union(*(new for *_, new in waiting))))
        ids = np.fromiter(map(self.index.__getitem__, chain.from_iterable(words for _, words, _ in waiting)), np.int64)
        self.uses += np.bincount(ids, minlength=len(self.uses))
        for (i, *_), part in zip(waiting, np.split(ids, np.cumsum([len(words) for _, words, _ in waiting[:-1]]))):
            yield i, part


#: words that a Python worker keeps from one task to the next
_KEPT: dict = {}


def _kept(shared) -> Words:
    key = tuple(hashlib.sha256(x).digest() for x in shared.value)
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Words(*shared.value)
    return _KEPT[key]


def _texts(batch: pa.RecordBatch) -> list[str]:
    """Texts; null and what is not UTF-8 is empty."""
    out = []
    for t in utf8(batch, "text"):
        try:
            out.append((t or b"").decode())
        except UnicodeDecodeError:
            out.append("")
    return out


def _by_text(words: Words, texts: list[str]):
    """``(i, ids of all words)`` of each text that has tokens, its blocks one after another."""
    at, held = None, []
    for i, ids in words.placed(texts):
        if i != at:
            if held and all(words.same[x].all() for x in held):
                yield at, held
            at, held = i, []
        if texts[i]:
            held.append(ids)
    if held and all(words.same[x].all() for x in held):
        yield at, held


#: figures of a text by itself, and those that need the counts of the corpus
OWN = ("n_a", "n_b", "n_groups", "n_links")
SHARED = ("n_best", "count_sum")


def aligned(docs: DataFrame, shared) -> DataFrame:
    """A row with ``doc_id``, its own figures and its links' id pairs for every
    text, and in between rows of ``pair, n`` that add up a task's links."""
    def run(batches):
        words = _kept(shared)
        kind = np.uint32 if words.narrow else np.int64

        def counted(n):
            of_pair = np.repeat(n, words.sizes[:len(n), 3])
            pair, at = np.unique(words.pairs[:len(of_pair)], return_inverse=True)
            total = np.bincount(at, of_pair, len(pair)).astype(np.int64)
            pair, total = pair[total > 0], total[total > 0]
            none = len(pair)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(none, pa.int64())] * (2 + len(OWN)) + [pa.nulls(none, pa.string()), pa.nulls(none, pa.binary()), pa.array(pair), pa.array(total)],
                names=names)

        names, n = ["doc_id", "row", *OWN, "groups_sha256", "links", "pair", "n"], np.zeros(0, np.int64)
        for b in slices(batches):
            if words.full():
                if len(n):
                    yield counted(n)
                words.shrink()
                n = np.zeros(0, np.int64)
            texts = _texts(b)
            sums, digests, found = np.zeros((len(texts), len(OWN)), np.int64), [""] * len(texts), [b""] * len(texts)
            for i, held in _by_text(words, texts):
                n = np.concatenate([n, np.zeros(len(words.index) - len(n), np.int64)])
                text = hashlib.sha256()
                for j, ids in enumerate(held):
                    np.add.at(n, ids, 1)
                    sums[i] += words.sizes[ids].sum(axis=0)
                    text.update(((";" if j else "") + ";".join(map(words.strings.__getitem__, ids.tolist()))).encode())
                digests[i] = text.hexdigest()
                found[i] = b"".join(words.pairs[_ranges(words.ptr, ids)].astype(kind).tobytes() for ids in held)
            no = pa.nulls(len(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), column(b, "row"), *(pa.array(x) for x in sums.T.copy()), pa.array(digests, pa.string()),
                                              pa.array(found, pa.binary()), no, no], names=names)
        if len(n):
            yield counted(n)

    return docs.mapInArrow(run, "doc_id long, row long, " + ", ".join(f"{c} long" for c in OWN)
                           + ", groups_sha256 string, links binary, pair long, n long")


def _pairs(links: list[bytes], narrow: bool) -> tuple[np.ndarray, np.ndarray]:
    """Id pairs of a batch of texts, and where each text's end."""
    pairs = np.frombuffer(b"".join(links), np.uint32 if narrow else np.int64)
    return pairs, np.cumsum([len(x) for x in links]) // pairs.itemsize


def looked_up(texts: DataFrame, table, narrow: bool) -> DataFrame:
    """Texts with the figures that need the corpus, from the broadcast ``table``:
    id pairs in order, their counts, whether that is the most of their B id."""
    def run(batches):
        keys, counts, best = table.value
        for b in slices(batches):
            pairs, stop = _pairs(column(b, "links").to_pylist(), narrow)
            at = np.searchsorted(keys, pairs)
            upto = (np.concatenate([[0], np.cumsum(x[at])]) for x in (best, counts))
            more = [pa.array(np.diff(u[np.concatenate([[0], stop])])) for u in upto]
            yield pa.RecordBatch.from_arrays([column(b, c) for c in ("doc_id", *OWN)] + more + [column(b, "groups_sha256")],
                                             names=["doc_id", *OWN, *SHARED, "groups_sha256"])

    return texts.select("doc_id", *OWN, "groups_sha256", "links").mapInArrow(
        run, "doc_id long, " + ", ".join(f"{c} long" for c in OWN + SHARED) + ", groups_sha256 string")


def joined(texts: DataFrame, rated: DataFrame, narrow: bool) -> DataFrame:
    """The same by a join on the id pair with ``rated(pair, n, best)``."""
    def run(batches):
        for b in slices(batches, 64):
            pairs, stop = _pairs(column(b, "links").to_pylist(), narrow)
            for row, part in zip(column(b, "row").to_pylist(), np.split(pairs, stop[:-1])):
                pair, m = np.unique(part, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), row)), pa.array(pair.astype(np.int64)), pa.array(m.astype(np.int64))],
                                                 names=["row", "pair", "m"])

    sums = (texts.where("n_links > 0").select("row", "links").mapInArrow(run, "row long, pair long, m long").join(rated, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"), F.sum(F.col("m") * F.col("n")).alias("count_sum")))
    return texts.join(sums, "row", "left").na.fill(0, [*SHARED]).select("doc_id", *OWN, *SHARED, "groups_sha256")


def align(docs: DataFrame, json_path: str, model_path: str, pairs_kept: int = PAIRS_KEPT) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``
    for every row of ``docs(doc_id, text)``.

    ``json_path`` is a byte-level BPE file (A, of space + text), ``model_path``
    a sentencepiece model that adds the space itself (B); both are read on the
    driver and broadcast, their size is that of the vocabularies. Texts that
    are null, empty or not UTF-8, and those that either tokenizer's tokens do
    not make up byte for byte, have no tokens: zeros and ''. They count for no
    id pair. Repeated rows count each time and give repeated results; a null
    doc_id stays null; other columns are not looked at. A text of any length is
    taken whole, a block of units at a time; a unit of any length is kept whole
    in memory, as are a text's id pairs (some four bytes for each token).
    """
    spark = docs.sparkSession
    files = []
    for path in (json_path, model_path):
        with open(path, "rb") as f:
            files.append(f.read())
    words = Words(*files)
    n_b, narrow = len(words.bytes_b), words.narrow
    shared = spark.sparkContext.broadcast(tuple(files))
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    table = written(aligned(numbered, shared), "align-texts")
    counts = written(table.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("n")), "align-pairs")
    texts = table.where("pair is null")
    if counts.count() <= pairs_kept:
        found = counts.sort("pair").toPandas()
        pairs, n = found["pair"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
        b, of_b = np.unique(pairs % n_b, return_inverse=True)
        most = np.zeros(len(b), np.int64)
        np.maximum.at(most, of_b, n)
        kept = spark.sparkContext.broadcast((pairs.astype(np.uint32 if narrow else np.int64), n, (n == most[of_b]).astype(np.int64)))
        return looked_up(texts, kept, narrow)
    most = counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("most"))
    rated = counts.withColumn("b", F.col("pair") % n_b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    return joined(texts, rated, narrow)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    return align(read(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))


QUERIES = {"op12_token_alignment": op12_token_alignment}
#: SQL has neither tokenizer
ORACLE: dict[str, str] = {}
