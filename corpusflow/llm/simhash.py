"""SimHash near-dedup by a grid over segment bit counts (operator 13).

A text's word shingles vote on the 64 bits of its fingerprint. Fingerprints
are parted into 32 segments of two bits and mapped to the bit count of each
segment: the Manhattan distance of two such vectors is never more than the
number of differing bits. So two fingerprints within three bits have one half
(16 segments) whose counts are at most one apart. Each half is a cell of a
grid; a fingerprint stands in its own cell and looks into that cell and those
one count up, so every pair in question meets once for each half that is near,
and is verified on the differing bits inside the join.

Documents of equal fingerprint are one point. Points that differ within one
run of three bits only are all linked with one another, at most eight to a
run, and are joined first by a star; the grid then looks only for links
between points that are not yet in one component. The result is exact. The
work of the grid is the number of points times 28 rows, and the comparisons
inside a cell; a half's cell holds one point in about seven million of evenly
spread ones, more where fingerprints crowd.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import column, read, slices, utf8, written
from corpusflow.llm.neardup import components

BITS = 64
#: seed of the shingle hash
SEED = 42
#: shingles whose bits are counted at a time
BLOCK = 1 << 14
#: differing bits that the two halves of the grid can tell
MOST = 3
#: the lower bit of each segment of two bits
LOWER = int("01" * 32, 2)


def fingerprint(text: bytes | None, k: int) -> int:
    """The fingerprint of a text: bit i is 1 if over half of its ``k``-word
    shingles (repeats count) have it set in their XXH64; 0 without words."""
    import xxhash
    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return 0
    m = min(k, n)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:n - m] + 1])
    ends = ends[m - 1:]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n - m + 1, BLOCK):
        h = np.array([xxhash.xxh64_intdigest(joined[i:j], SEED)
                      for i, j in zip(starts[at:at + BLOCK].tolist(), ends[at:at + BLOCK].tolist())], np.dtype("<u8"))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n - m + 1, bitorder="little").view(np.dtype("<u8"))[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, print`` (the 64 bits as a signed long) of every row of ``docs(doc_id, text)``."""
    def run(batches):
        for b in slices(batches):
            p = np.array([fingerprint(t, shingle) for t in utf8(b, "text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(p)], names=["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, print long")


def segment_counts(p: Column) -> Column:
    """Bit counts of the 32 segments, two bits each, packed in a long."""
    up = F.shiftrightunsigned(p, 1)
    two = F.shiftleft(p.bitwiseAND(up).bitwiseAND(F.lit(LOWER)), 1)
    return two.bitwiseOR(p.bitwiseXOR(up).bitwiseAND(F.lit(LOWER)))


def signed(x: int) -> int:
    """64 bits as Spark's long has them."""
    return x - (1 << BITS) if x >> BITS - 1 else x


def clique_edges(points: DataFrame, distance: int) -> DataFrame:
    """``a, b``: points of ``points(rep, print)`` that are equal but for one run of ``distance`` bits."""
    runs = [(i, ((1 << distance) - 1) << i & (1 << BITS) - 1) for i in range(0, BITS, distance)]
    keys = [F.struct(F.lit(i).alias("run"), F.col("print").bitwiseAND(F.bitwise_not(F.lit(signed(run)))).alias("rest")) for i, run in runs]
    # at most 2 ** distance points share all other bits
    near = (points.select("rep", F.explode(F.array(*keys)).alias("key")).groupBy("key.run", "key.rest")
            .agg(F.min("rep").alias("a"), F.collect_list("rep").alias("all")).where(F.size("all") > 1))
    return near.select("a", F.explode("all").alias("b")).where("a <> b").distinct()


def grid_links(points: DataFrame, distance: int) -> DataFrame:
    """``a, b``: components of ``points(rep, print, component)`` that a link of
    at most ``distance`` differing bits joins, each pair once."""
    counts = points.select("print", "component", segment_counts(F.col("print")).alias("counts"))
    halves = counts.select("print", "component", F.posexplode(F.array(
        F.col("counts").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("counts", 32))).alias("half", "cell"))
    # one count up in a segment that is not full
    up = [F.when(F.shiftright("cell", 2 * i).bitwiseAND(F.lit(3)) < 2, F.col("cell") + (1 << 2 * i)) for i in range(16)]
    looks = halves.select(F.col("print").alias("print_x"), F.col("component").alias("component_x"), F.col("half").alias("half_x"),
                          F.col("cell").alias("own"), F.explode(F.array_compact(F.array(F.col("cell"), *up))).alias("cell_x"))
    found = looks.join(halves, (F.col("half_x") == F.col("half")) & (F.col("cell_x") == F.col("cell"))
                       & (F.col("component_x") != F.col("component"))
                       & (F.bit_count(F.col("print_x").bitwiseXOR(F.col("print"))) <= distance)
                       & ((F.col("own") != F.col("cell")) | (F.col("print_x") < F.col("print"))))
    return found.select(F.least("component_x", "component").alias("a"), F.greatest("component_x", "component").alias("b")).distinct()


def simhash_groups(docs: DataFrame, shingle: int = 3, distance: int = MOST) -> DataFrame:
    """``doc_id, print, component_id`` for every row of ``docs(doc_id, text)``.

    Rows are linked when their fingerprints differ in ``distance`` bits or
    fewer (0 to 3); ``component_id`` is the smallest doc_id reachable. Null,
    empty and blank texts have fingerprint 0, linked like any other. A row
    without doc_id has its fingerprint, is linked with nothing and has a null
    component. Rows that repeat a doc_id count as one document with all their
    links. Other columns are not looked at; texts of any length are taken whole.
    """
    if not 0 <= distance <= MOST:
        raise ValueError(f"the halves of the grid tell up to {MOST} differing bits")
    table = written(fingerprints(docs, shingle), "simhash-prints")
    named = table.where("doc_id is not null")
    points = written(named.groupBy("print").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "simhash-points")
    same = named.groupBy("doc_id").agg(F.min("print").alias("lo"), F.max("print").alias("hi")).where("lo < hi").select("doc_id")
    # a doc_id that stands for several fingerprints joins their points
    edges = named.join(same, "doc_id").join(points, "print").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    if distance:
        edges = edges.union(clique_edges(points, distance))
    one = components(edges)
    placed = written(points.join(one.toDF("rep", "up"), "rep", "left").select("print", "rep", "n", F.coalesce("up", "rep").alias("component")),
                     "simhash-placed")
    if distance:
        two = components(grid_links(placed, distance))
        placed = placed.join(two.toDF("component", "top"), "component", "left").withColumn("component", F.coalesce("top", "component"))
    moved = placed.where("n > 1 or component <> rep").select(F.col("print").alias("print_of"), "component")
    return table.join(moved, table.print == moved.print_of, "left").select(
        "doc_id", "print", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def op13_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op13_simhash_groups": op13_simhash_groups}
#: XXH64 is not a function of the SQL dialect
ORACLE: dict[str, str] = {}
