"""Benchmark decontamination by a broadcast set of test n-grams (operator 6).

The windows of the test items go into a hash set that every task holds; each
training text is read once and its token windows are looked up and verified
word by word. The set is broadcast only up to a checked size; a larger
benchmark is taken in shards, one pass over the texts for each, with the hits
so far carried along in a written table.
"""

from __future__ import annotations

import math
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.common import column, read, slices, utf8, written

#: words in a window
WINDOW = 13
#: bytes of item text that may be broadcast at once
BROADCAST_BYTES = 16 << 20

# A-Z to a-z; digits, letters and all bytes of non-ASCII characters stay; the rest separates
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class WindowSet:
    """Windows of the items: window -> item ids, by window length."""

    def __init__(self, items, window: int):
        self.windows: dict[int, dict[bytes, list[str]]] = {}
        for item_id, text in items:
            w = words_of(text.encode() if isinstance(text, str) else text)
            n = min(window, len(w))
            for i in range(len(w) - n + 1 if n else 0):
                ids = self.windows.setdefault(n, {}).setdefault(b" ".join(w[i:i + n]), [])
                if item_id not in ids:
                    ids.append(item_id)
        self.known = dict.fromkeys((x for d in self.windows.values() for k in d for x in k.split(b" ")), 1)
        self.shortest = min(self.windows, default=0)

    def scan(self, words: list[bytes]) -> tuple[list[int], set[str]]:
        """Hit word ranges as a flat list start, end, ... and the ids that occur."""
        if not self.shortest or len(words) < self.shortest:
            return [], set()
        # only runs of words that some item has can hold a window
        other = np.flatnonzero(np.fromiter(map(self.known.get, words, repeat(0)), np.int8, len(words)) == 0)
        edge = np.concatenate(([-1], other, [len(words)]))
        spans, found = [], set()
        for k in np.flatnonzero(np.diff(edge) > self.shortest):
            lo, hi = int(edge[k]) + 1, int(edge[k + 1])
            for n, table in self.windows.items():
                for i in range(lo, hi - n + 1):
                    ids = table.get(b" ".join(words[i:i + n]))
                    if ids is not None:
                        spans.append((i, i + n))
                        found.update(ids)
        return _merged(spans), found


def _merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


_SCHEMA = T.StructType().add("n_words", T.LongType()).add("hits", T.ArrayType(T.IntegerType())).add("items", T.ArrayType(T.StringType()))


def _pass(docs: DataFrame, shared, keep: list[str]) -> DataFrame:
    """One look at the texts against one broadcast set; earlier hits are kept."""
    fields = [T.StructField(f.name, f.dataType) for f in docs.schema.fields if f.name in keep]

    def run(batches):
        index = shared.value
        for b in slices(batches):
            before = (column(b, "hits").to_pylist(), column(b, "items").to_pylist()) if "hits" in b.schema.names else None
            n, hits, items = [], [], []
            for r, text in enumerate(utf8(b, "text")):
                w = words_of(text)
                spans, found = index.scan(w)
                if before and before[0][r]:
                    h = before[0][r]
                    spans = _merged([*zip(h[::2], h[1::2]), *zip(spans[::2], spans[1::2])])
                if before:
                    found.update(before[1][r])
                n.append(len(w))
                hits.append(spans)
                items.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [*(column(b, c) for c in keep), pa.array(n, pa.int64()), pa.array(hits, pa.list_(pa.int32())),
                 pa.array(items, pa.list_(pa.string()))], names=[*keep, "n_words", "hits", "items"])

    return docs.mapInArrow(run, T.StructType(fields + _SCHEMA.fields))


def _shards(benchmark: DataFrame, max_bytes: int) -> list[DataFrame]:
    """The items, in as many parts as the broadcast limit takes."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             F.coalesce(F.col("text"), F.lit("")).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, math.ceil(size / max_bytes))
    return [items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def _shared(part: DataFrame, window: int):
    rows = ((r[0], r[1]) for r in part.toLocalIterator())
    return part.sparkSession.sparkContext.broadcast(WindowSet(rows, window))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_bytes: int = BROADCAST_BYTES,
         with_text: bool = False) -> DataFrame:
    """``doc_id[, text], n_words, hits, items`` for every row of ``docs(doc_id, text)``.

    ``hits`` are merged word ranges (start, end, ...) covered by windows of
    ``benchmark(item_id, text)``; ``items`` the ids (as sorted text) that
    occur. Null and empty texts have no words and no hits; items without words
    have no window; an item without id goes by the id ``''``; repeated items
    count once by id; an empty benchmark hits nothing. Other columns of either
    table are not looked at.
    """
    shards = _shards(benchmark, max_bytes)
    keep = ["doc_id", "text"] if with_text else ["doc_id"]
    df = docs.select("doc_id", "text")
    for k, part in enumerate(shards):
        last = k == len(shards) - 1
        df = _pass(df, _shared(part, window), keep if last else ["doc_id", "text"])
        if not last:
            df = written(df, "decontaminate").select("doc_id", "text", "hits", "items")
    return df


def n_hit() -> F.Column:
    """Words inside the merged ranges of ``hits``."""
    return F.aggregate(F.transform("hits", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0),
                       lambda a, x: a + x).cast("long")


def contaminated() -> F.Column:
    """A twentieth of the words or more are hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated.

    With one shard the rows are filtered as they are read; with more, hits add
    up over the passes first.
    """
    shards = _shards(benchmark, max_bytes)
    if len(shards) > 1:
        # hits of all shards count together: carried as extra columns of the rows
        columns, row = docs.columns, F.struct(*docs.columns)
        packed = docs.select(row.alias("doc_id"), "text")
        found = scan(packed, benchmark, window, max_bytes).select("doc_id", "n_words", n_hit().alias("n_hit"))
        return found.where(~contaminated()).select(*(F.col("doc_id")[c].alias(c) for c in columns))
    shared = _shared(shards[0], window)

    def run(batches):
        index = shared.value
        for b in slices(batches):
            keep = []
            for text in utf8(b, "text"):
                w = words_of(text)
                hits, _ = index.scan(w)
                n = sum(hits[1::2]) - sum(hits[::2])
                keep.append(not (n > 0 and 20 * n >= len(w)))
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _without_spans(text: str | None, hits: list[int]) -> str | None:
    """``text`` without the bytes from the first to the last word of each range."""
    if not hits:
        return text
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw)]
    out, end = [], 0
    for a, b in zip(hits[::2], hits[1::2]):
        out.append(raw[end:at[a][0]])
        end = at[b - 1][1]
    return b"".join([*out, raw[end:]]).decode()


def remove_spans(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """``doc_id, text, n_words, n_hit``: every text without its hit words."""
    found = scan(docs, benchmark, with_text=True, **kw).select("doc_id", "text", "n_words", n_hit().alias("n_hit"), "hits")

    def run(batches):
        for b in slices(batches):
            text = [_without_spans(t, h) for t, h in zip(column(b, "text").to_pylist(), column(b, "hits").to_pylist())]
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(text, pa.string()), column(b, "n_words"),
                                              column(b, "n_hit")], names=["doc_id", "text", "n_words", "n_hit"])

    kind = T.StructType().add("doc_id", docs.schema["doc_id"].dataType).add("text", T.StringType())
    return found.mapInArrow(run, kind.add("n_words", T.LongType()).add("n_hit", T.LongType()))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return (found.select("doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))
            .withColumn("contaminated", contaminated()))


_SQL_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

QUERIES = {"op6_decontamination": op6_decontamination}
ORACLE = {"op6_decontamination": f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_SQL_WORDS} AS w FROM benchmark),
bw AS (SELECT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
       FROM b, LATERAL (SELECT unnest(range(1, len(b.w) - least(13, len(b.w)) + 2)) AS i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, lens.n AS n, i, array_to_string(w[i:i + lens.n - 1], ' ') AS win
       FROM d, lens, LATERAL (SELECT unnest(range(1, len(d.w) - lens.n + 2)) AS i) WHERE len(w) >= lens.n),
h AS (SELECT doc_id, item_id, i, dw.n AS n FROM dw JOIN bw USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM h, LATERAL (SELECT unnest(range(h.i, h.i + h.n)) AS p) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
       FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""}
