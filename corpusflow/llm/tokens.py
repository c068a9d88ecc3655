"""Token counts by heap-and-linked-list byte-pair merging (operator 9).

A piece's bytes are the first symbols, held in a linked list. The adjacent
pairs are entries ``rank << 32 | place``; the lowest is popped and merged, and
its two new neighbour pairs are ranked, until no pair has a rank. The token
count is the number of first symbols less the number of merges; no identifiers
are made.

Long pieces use a heap each. The many short ones of a batch are merged side by
side: their entries and links lie in shared arrays, and one step pops the
lowest entry of every piece (a minimum by segment stands for the tops of that
many small heaps). Pieces met before are looked up in a bounded table.
"""

from __future__ import annotations

import json
import re
from heapq import heapify, heappop, heappush
from itertools import chain, filterfalse, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import column, read, slices

#: entries of a table of counts in one Python worker; the table starts anew beyond
WORDS_KEPT = 400_000
#: bytes up to which a piece is merged side by side with others
SIDE_BY_SIDE = 64
#: a place that no ranked pair starts at
NO_PAIR = np.int64(2**62)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


def load_merges(path: str) -> tuple[dict[int, int], list[int], list[str]]:
    """Pair ranks, first symbol of each byte and special strings of a byte-level BPE ``.json`` file.

    A byte's symbol is a number below 256 and that of merge ``rank`` is ``256 +
    rank``; a pair's key is ``left << 32 | right``. Refuses a file whose
    settings this operator does not reproduce, so a count is never silently
    different from the library's.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec["pre_tokenizer"], spec["model"]
    plain = (model["type"] == "BPE" and pre["type"] == "ByteLevel" and pre.get("use_regex", True)
             and not pre["add_prefix_space"] and spec["normalizer"] is None
             and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix",
                                                "byte_fallback", "ignore_merges")))
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    symbols = byte_symbols()
    number = {s: i for i, s in enumerate([*symbols, *(a + b for a, b in pairs)])}
    if not plain or len(number) != 256 + len(pairs) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError(f"{path} is not a plain byte-level BPE file")
    ranks = {number[a] << 32 | number[b]: i for i, (a, b) in enumerate(pairs)}
    return ranks, [number[s] for s in symbols], [t["content"] for t in spec["added_tokens"]]


def merge_count(syms: list[int], ranks: dict[int, int]) -> int:
    """Tokens that the symbols ``syms`` (overwritten) merge into."""
    size = tokens = len(syms)
    get, none = ranks.get, -1
    rank = [get(a << 32 | b, none) for a, b in zip(syms, syms[1:])]  # of the pair that starts here
    rank.append(none)
    heap = [r << 32 | i for i, r in enumerate(rank) if r >= 0]
    heapify(heap)
    right, left = list(range(1, size + 1)), list(range(-1, size - 1))
    while heap:
        top = heappop(heap)
        i, r = top & 0xFFFFFFFF, top >> 32
        if rank[i] != r:
            continue  # one of the two has been merged since
        j = right[i]
        k = right[i] = right[j]
        syms[i], rank[j], rank[i] = 256 + r, none, none
        tokens -= 1
        if k < size:
            left[k] = i
            rank[i] = r = get(syms[i] << 32 | syms[k], none)
            if r >= 0:
                heappush(heap, r << 32 | i)
        h = left[i]
        if h >= 0:
            rank[h] = r = get(syms[h] << 32 | syms[i], none)
            if r >= 0:
                heappush(heap, r << 32 | h)
    return tokens


class Merger:
    """Token counts of many pieces at once."""

    def __init__(self, ranks: dict[int, int], first: list[int]):
        self.ranks, self.first = ranks, first
        self.symbol = np.array(first, np.int64)
        # pair ranks as an open hash table: few probes, all pairs of a step at once
        self.mask = (1 << max(8, (4 * len(ranks)).bit_length())) - 1
        self.keys, self.rank = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, -1, np.int64)
        keys, rank = np.fromiter(ranks.keys(), np.int64, len(ranks)), np.fromiter(ranks.values(), np.int64, len(ranks))
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]  # of several for one slot the last stays
            here = self.keys[slot] == keys
            self.rank[slot[here]] = rank[here]
            keys, rank, slot = keys[~here], rank[~here], slot[~here] + 1 & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * -7046029254386353131 >> 20) & self.mask

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Ranks of pairs, -1 where a pair has none."""
        out, slot, at = np.full(len(keys), -1, np.int64), self._slot(keys), np.arange(len(keys))
        while len(at):
            there = self.keys[slot]
            hit = there == keys
            out[at[hit]] = self.rank[slot[hit]]
            more = ~hit & (there != -1)
            at, keys, slot = at[more], keys[more], slot[more] + 1 & self.mask
        return out

    def count(self, pieces: list[bytes]) -> list[int]:
        long = [len(p) > SIDE_BY_SIDE for p in pieces]
        short = iter(self._side_by_side([p for p, x in zip(pieces, long) if not x]))
        return [merge_count([self.first[b] for b in p], self.ranks) if x else next(short) for p, x in zip(pieces, long)]

    def _entries(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        r = self.lookup(left << 32 | right)
        return np.where(r >= 0, r << 32 | at, NO_PAIR)

    def _side_by_side(self, pieces: list[bytes]) -> list[int]:
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        tokens, n = size.copy(), int(size.sum())
        if not n:
            return tokens.tolist()
        sym = self.symbol[np.frombuffer(b"".join(pieces), np.uint8)]
        start = np.cumsum(size) - size
        # left and right neighbours; places of other pieces count as none
        right, left = np.arange(1, n + 1), np.arange(-1, n - 1)
        head, end = np.repeat(start, size), np.repeat(start + size, size)
        heap = np.full(n, NO_PAIR)
        at = np.flatnonzero(right < end)
        heap[at] = self._entries(sym[at], sym[at + 1], at)
        piece = np.flatnonzero(size > 0)
        while True:
            top = np.minimum.reduceat(heap, start[piece])  # finished pieces in between have no pair left
            live = top != NO_PAIR
            piece, top = piece[live], top[live]
            if not len(piece):
                return tokens.tolist()
            i, rank = top & 0xFFFFFFFF, top >> 32
            j = right[i]
            k = right[i] = right[j]
            sym[i], heap[i], heap[j] = rank + 256, NO_PAIR, NO_PAIR
            tokens[piece] -= 1
            some = k < end[i]
            a, b = i[some], k[some]
            left[b] = a
            heap[a] = self._entries(sym[a], sym[b], a)
            h = left[i]
            some = h >= head[i]
            a, b = h[some], i[some]
            heap[a] = self._entries(sym[a], sym[b], a)


class Words:
    """Token counts of texts, with bounded tables of what was met before."""

    def __init__(self, ranks: dict, first: list[int], pattern: str):
        import regex
        self.cut, self.merger = regex.compile(pattern).findall, Merger(ranks, first)
        self.words: dict[str, int] = {}  # text from a space up to the next one, without the space
        self.pieces: dict[str, int] = {}
        white = "".join(c for c in map(chr, range(0x3001)) if regex.match(r"\s", c))
        # white space in which a space is neither first nor right before a word
        self.odd = re.compile(f"[{re.escape(white)}] (?:[{re.escape(white)}]|\\Z)").search

    def _learn(self, table: dict[str, int], new: list[str], pieces: list[bytes]) -> None:
        table.update(zip(new, self.merger.count(pieces)))

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text. A single space starts a piece, so a text may be
        cut at spaces, unless white space comes in runs with spaces inside."""
        for table in (self.words, self.pieces):
            if len(table) > WORDS_KEPT:
                table.clear()
        parts = []
        new: set[str] = set()
        for t in texts:
            whole = self.odd(t)
            head, *rest = [t] if whole else t.split(" ")
            parts.append((self.cut(head), rest))
            new.update(filterfalse(self.words.__contains__, rest))
        plain = [w for w in new if w.isalpha() and w.isascii()]  # one piece each
        self._learn(self.words, plain, [b" " + w.encode() for w in plain])
        new.difference_update(plain)
        cuts = [self.cut(" " + w) for w in new]
        pieces: set[str] = set()
        for p in chain(cuts, (p for p, _ in parts)):
            pieces.update(filterfalse(self.pieces.__contains__, p))
        known = list(pieces)
        self._learn(self.pieces, known, [p.encode() for p in known])
        piece = self.pieces.__getitem__
        self.words.update(zip(new, [sum(map(piece, c)) for c in cuts]))
        return [sum(map(piece, p)) + sum(map(self.words.__getitem__, w)) for p, w in parts]


#: counts that a Python worker keeps from one task to the next
_KEPT: dict = {}


def count_tokens(docs: DataFrame, path: str, pattern: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs(doc_id, text)``.

    ``path`` is a byte-level BPE file read on the driver and broadcast (its
    size is that of the vocabulary, whatever the corpus); ``pattern``, the
    byte-level one, splits text before the merges. Special strings inside a text count one
    token each, as the library does by default. Null and empty texts have 0
    bytes and 0 tokens; a null doc_id stays null; repeated rows give repeated
    results; other columns are not looked at. A text of any length is counted
    whole.
    """
    ranks, first, special = load_merges(path)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, first))

    def run(batches):
        import regex
        if (path, pattern) not in _KEPT:
            _KEPT.clear()
            _KEPT[path, pattern] = Words(*shared.value, pattern)
        words = _KEPT[path, pattern]
        cut = regex.compile("|".join(map(regex.escape, special))).split if special else lambda t: [t]
        for b in slices(batches):
            parts = [cut(t) for t in column(b, "text").to_pylist()]
            counts = iter(words.count([x for p in parts for x in p]))
            out = [sum(islice(counts, len(p))) + len(p) - 1 for p in parts]
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc_id"), column(b, "n_bytes"), pa.array(out, pa.int64()), pa.array([x > limit for x in out], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
            .mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    return count_tokens(read(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), P.PATTERN)


QUERIES = {"op9_token_counts": op9_token_counts}
ORACLE: dict[str, str] = {}
