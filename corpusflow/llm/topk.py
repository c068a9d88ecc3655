"""Exact top-k search by exhaustive term-at-a-time accumulation (operator 2).

Rows are sparse vectors of integer weights. Candidates are dealt to lanes; a
lane holds, for each term, a posting list of (place, weight). Every query is
sent to every lane: for each of its terms the weighted postings are scattered
into a dense array of scores, the best k are picked by partition selection,
and the picks of all lanes are merged by query. All scores are computed;
nothing is pruned or sampled.

The query set is a stated part of the rows, so the work is queries times
rows. A lane's candidates are held in memory (rows / lanes; raise
``spark.sql.shuffle.partitions`` with the data), its queries stream past in
blocks; what is shuffled is the candidates once, the queries once for each
lane, and k rows for each query and lane.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corpusflow.llm.common import column, read

#: candidates and queries whose scores are in memory at once
TILE = 2048
QUERY_BLOCK = 64


def _usable(vec: str) -> F.Column:
    """Not null and without null or non-finite components."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vec).isNotNull() & ~F.coalesce(bad, F.lit(True))


def weights(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """``vec_id, w``: floor(scale * x) of each component of the usable vectors."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    return v.where(F.col("vec_id").isNotNull() & _usable("x")).select(
        "vec_id", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("w"))


def accumulate(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Scores (queries x candidates), one term after another.

    The postings of a term are its candidates of non-zero weight; queries of
    non-zero weight scatter weight * posting into their arrays of scores. A
    list with most of the candidates is added whole.
    """
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * min(q.shape[1], c.shape[1])
    kind = np.int32 if bound < 2**31 else np.int64
    q, c = q.astype(kind), np.ascontiguousarray(c.T, dtype=kind)
    scores = np.zeros((len(q), c.shape[1]), kind)
    for term in range(min(q.shape[1], len(c))):
        asked, posting = np.flatnonzero(q[:, term]), np.flatnonzero(c[term])
        if not len(asked) or not len(posting):
            continue
        if 2 * len(posting) < c.shape[1]:
            scores[np.ix_(asked, posting)] += np.multiply.outer(q[asked, term], c[term, posting])
        elif 2 * len(asked) < len(q):
            scores[asked] += np.multiply.outer(q[asked, term], c[term])
        else:
            scores += np.multiply.outer(q[:, term], c[term])
    return scores


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids, without the rows of id ``own``."""
    there = np.flatnonzero(ids != own)
    if len(there) <= k:
        return there
    s = scores[there]
    least = np.partition(s, len(s) - k)[len(s) - k]
    over, tied = there[s > least], there[s == least]
    return np.concatenate([over, tied[np.argsort(ids[tied], kind="stable")][:k - len(over)]])


def _matrix(col: pa.Array) -> np.ndarray:
    """A list column as a matrix, shorter rows filled up with zeros."""
    size = np.diff(np.asarray(col.offsets)).astype(int)
    m = np.zeros((len(size), size.max(initial=0)), np.int64)
    m[np.arange(m.shape[1]) < size[:, None]] = np.asarray(col.flatten(), dtype=np.int64)
    return m


class _Lane:
    """The candidates of one lane, in tiles."""

    def __init__(self):
        self.ids, self.tiles = [], []

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        for at in range(0, len(ids), TILE):
            self.ids.append(ids[at:at + TILE])
            self.tiles.append(rows[at:at + TILE].astype(np.int32) if np.abs(rows).max(initial=0) < 2**31 else rows[at:at + TILE])

    def answer(self, own: np.ndarray, q: np.ndarray, k: int):
        """(ids, scores) of each query's best k of the lane."""
        found = [([], []) for _ in own]
        for ids, rows in zip(self.ids, self.tiles):
            scores = accumulate(q, rows)
            for f, o, s in zip(found, own, scores):
                at = best(s, ids, o, k)
                f[0].append(ids[at])
                f[1].append(s[at].astype(np.int64))
        for f, o in zip(found, own):
            ids, s = np.concatenate(f[0]), np.concatenate(f[1])
            at = best(s, ids, o, k)
            yield ids[at], s[at]


def search(queries: DataFrame, candidates: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries(vec_id, w)`` the k
    rows of ``candidates(vec_id, w)`` with the highest inner product.

    Ties go to the smaller vec_id; rows with the query's own vec_id are left
    out; a vector that is shorter than another has weight 0 beyond its end, so
    an empty one scores 0; queries that repeat a vec_id are answered once (by
    one of them, if their vectors differ); candidates that repeat one are
    answered each. Without candidates there are no rows.
    """
    lanes = max(int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    every = F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))
    c = candidates.select(F.pmod(F.xxhash64("vec_id"), F.lit(lanes).cast("long")).alias("lane"), F.lit(False).alias("asks"), "vec_id", "w")
    q = queries.dropDuplicates(["vec_id"]).select(F.explode(every).alias("lane"), F.lit(True).alias("asks"), "vec_id", "w")
    # in each lane all candidates come before the first query
    meet = c.unionByName(q).repartition(lanes, "lane").sortWithinPartitions("lane", "asks")

    def run(batches):
        lane, held = None, _Lane()
        for b in batches:
            lanes_, asks = np.asarray(column(b, "lane")), np.asarray(column(b, "asks").cast(pa.int8()))
            cuts = np.flatnonzero((np.diff(lanes_) != 0) | (np.diff(asks) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, b.num_rows]):
                if hi == lo:
                    continue
                if lanes_[lo] != lane:
                    lane, held = lanes_[lo], _Lane()
                for at in range(lo, hi, QUERY_BLOCK if asks[lo] else TILE):
                    part = b.slice(at, min(QUERY_BLOCK if asks[lo] else TILE, hi - at))
                    ids, rows = np.asarray(column(part, "vec_id")), _matrix(column(part, "w"))
                    if not asks[lo]:
                        held.add(ids, rows)
                    elif held.ids:
                        found = list(held.answer(ids, rows, k))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.repeat(ids, [len(f[0]) for f in found])), pa.array(np.concatenate([f[0] for f in found])),
                             pa.array(np.concatenate([f[1] for f in found]))], names=["query_id", "vec_id", "score"])

    top = meet.mapInArrow(run, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return top.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = weights(read(spark, sf_dir, "embeddings"))
    return search(rows.where(F.col("vec_id") % 20 == 0), rows, 20)


QUERIES = {"op2_top_k": op2_top_k}
ORACLE = {"op2_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""}
