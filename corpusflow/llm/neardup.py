"""MinHash near-dedup with odd sketches (operator 1).

Every text becomes the set of its distinct word shingles. 128 MinHash samples
of the set serve twice: banded four by four they give 32 bucket keys, and
folded by parity into a 256-bit odd sketch they estimate a pair's similarity
from the population count of two sketches' XOR. Pairs that share a bucket and
whose sketches are not plainly different are confirmed on the full sets. A
pair at the threshold of 0.8 shares no bucket with probability 5e-8; the
sketch bound lies six standard deviations away from it.

Copies never become pairs: equal sets are one class. Within a bucket the
classes are first confirmed against one leader; components are formed; then
only classes of one bucket that are still in different components are compared,
by size and by a parity bitmap of 4096 bits, and what passes is confirmed. For
sets of up to 4096 shingles the bitmap folds the whole set: its XOR never has
more bits than the two sets have different shingles, so no link is lost, and
hardly fewer for sets of some hundreds, so hardly any pair under the threshold
passes. Larger sets fold 2048 samples, which tells 0.68 from 0.8. So a group of
n near copies costs about n confirmations, unlike texts of a bucket cost a
comparison of bitmaps inside the join, and no link between components is lost.
Everything is keyed joins and map-side aggregates; the driver sees counts only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import column, mix64, read, slices, utf8, written

BANDS = 32
ROWS = 4
SAMPLES = BANDS * ROWS
#: bits of an odd sketch, in 64-bit words, and those of the sharper one
SKETCH_WORDS = 4
SHARP_SAMPLES = 2048
SHARP_WORDS = 64
#: shingles of a set that is folded whole into a sharper sketch
WHOLE = 4096
#: buckets of a leader that a member must share to be held against it first
LED = 4
#: words kept with their hash in one Python worker
WORDS_KEPT = 400_000

_rng = np.random.default_rng(91)
_MULTIPLY = _rng.integers(0, 1 << 32, SHARP_SAMPLES, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, SHARP_SAMPLES, dtype=np.uint32)
_BAND_MULTIPLY = _rng.integers(0, 1 << 63, (ROWS,), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_hashes(text: bytes | None, k: int, hashes: dict) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles of ``text``: words
    are parted by ASCII white space after A-Z are lower-cased; a text of fewer
    than k words, but not none, is one shingle."""
    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    m = min(k, n)
    s = np.full(n - m + 1, m, np.uint64)
    for i in range(m):
        s = mix64(s * np.uint64(0x9E3779B97F4A7C15) + h[i:n - m + 1 + i])
    return np.unique(s)


def sketch_limit(samples: int, bits: int, percent: int) -> int:
    """XOR bits that two sketches of sets at the threshold exceed with a
    probability of about 1e-9 (six standard deviations)."""
    apart = 1 - percent / 100
    grow = math.exp(-4 * samples * apart / bits)
    mean = bits / 2 * (1 - grow)
    # of the number of flips, carried over to bits, and of where the flips fall
    sd = math.hypot(2 * math.sqrt(samples * apart * (1 - apart)) * grow, math.sqrt(bits / 4 * (1 - grow * grow)))
    return math.ceil(mean + 6 * sd)


def min_hashes(shingles: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """MinHash samples of a non-empty set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(samples, 0xFFFFFFFF, np.uint32)
    step = 65536 // samples
    for at in range(0, len(x), step):
        np.minimum(out, (x[at:at + step, None] * _MULTIPLY[:samples] + _ADD[:samples]).min(axis=0), out=out)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """Bucket keys (docs x bands) of samples (docs x 128)."""
    s = samples.reshape(len(samples), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(samples), BANDS))
    for r in range(ROWS):
        key = mix64(key * _BAND_MULTIPLY[r] + s[:, :, r])
    return key


def odd_sketches(samples: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """Parity bitmaps (docs x words): sample i with value v flips bit hash(i, v)."""
    bits, n = words * 64, samples.shape[1]
    at = (mix64(samples.astype(np.uint64) * np.uint64(n) + np.arange(n, dtype=np.uint64)) % np.uint64(bits)).astype(int)
    rows = np.repeat(np.arange(len(samples)), n)
    odd = (np.bincount(rows * bits + at.ravel(), minlength=len(samples) * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(samples), bits), axis=1).view(np.uint64)


def sketch(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, n_shingles, set_key, bands, odd`` of every row; the last three are null for texts without words."""
    def run(batches):
        import xxhash
        hashes = _Hashes()
        for b in slices(batches):
            n, keys, samples = [], [], []
            for text in utf8(b, "text"):
                s = shingle_hashes(text, shingle, hashes)
                n.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                samples.append(min_hashes(s) if len(s) else np.zeros(SAMPLES, np.uint32))
            samples = np.array(samples).reshape(len(n), SAMPLES)
            none = pa.array([x is None for x in keys], pa.bool_())
            cols = []
            for a in (band_keys(samples), odd_sketches(samples)):
                flat = pa.array(np.ascontiguousarray(a).view(np.int64).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * a.shape[1]), flat)
                cols.append(pa.compute.if_else(none, pa.nulls(len(n), lists.type), lists))
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), *cols],
                                             names=["doc_id", "n_shingles", "set_key", "bands", "odd"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, bands array<long>, odd array<long>")


def set_sketches(sets: list[np.ndarray], words: int = SHARP_WORDS) -> np.ndarray:
    """Parity bitmaps (docs x words) of whole sets: each shingle flips one bit."""
    bits = words * 64
    at = mix64(np.concatenate([np.empty(0, np.uint64), *sets])) % np.uint64(bits)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    odd = (np.bincount(rows * bits + at.astype(int), minlength=len(sets) * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(sets), bits), axis=1).view(np.uint64)


def sharp_sketch(texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``rep, size, whole, sharp`` of the documents of ``texts``: the bitmap of the
    whole set and that of its samples. Each is null where no set of like size needs it."""
    def lists(odd, some):
        flat = pa.array(odd.view(np.int64).ravel())
        offsets = np.concatenate([[0], np.cumsum(some)]).astype(np.int32) * SHARP_WORDS
        return pa.ListArray.from_arrays(pa.array(offsets), flat, mask=pa.array(~some))

    def run(batches):
        hashes = _Hashes()
        for b in slices(batches, 64):
            sets = [shingle_hashes(t, shingle, hashes) for t in utf8(b, "text")]
            size = np.array([len(s) for s in sets], np.int64)
            small, large = size <= WHOLE, size * 100 > WHOLE * percent
            samples = np.array([min_hashes(s, SHARP_SAMPLES) for s, some in zip(sets, large) if some], np.uint32).reshape(-1, SHARP_SAMPLES)
            yield pa.RecordBatch.from_arrays([
                column(b, "doc_id"), pa.array(size), lists(set_sketches([s for s, some in zip(sets, small) if some]), small),
                lists(odd_sketches(samples, SHARP_WORDS), large)], names=["rep", "size", "whole", "sharp"])

    return texts.mapInArrow(run, "rep long, size long, whole array<long>, sharp array<long>")


def _alike(percent: int) -> Column:
    """Sizes and sharper sketches of sets x and y allow a link."""
    sizes = (F.col("size_x") * 100 >= F.col("size_y") * percent) & (F.col("size_y") * 100 >= F.col("size_x") * percent)
    # a link has at most this share of the sizes' sum in shingles that only one side has
    whole = _bits("whole_x", "whole_y", SHARP_WORDS) * (100 + percent) <= (F.col("size_x") + F.col("size_y")) * (100 - percent)
    sampled = _bits("sharp_x", "sharp_y", SHARP_WORDS) <= sketch_limit(SHARP_SAMPLES, SHARP_WORDS * 64, percent)
    return sizes & F.when((F.col("size_x") <= WHOLE) & (F.col("size_y") <= WHOLE), whole).otherwise(sampled)


def _bits(a: str, b: str, words: int) -> Column:
    """Bits in which two sketches differ."""
    bits = [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(words)]
    return sum(bits[1:], bits[0])


def _first_meeting(a: str, b: str, band: Column) -> Column:
    """The two share no bucket of an earlier band, so a pair comes once."""
    earlier = [F.slice(c, F.lit(1), band) for c in (a, b)]
    return ~F.exists(F.zip_with(*earlier, lambda x, y: x == y), lambda same: same)


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those ``pairs(a, b)`` whose full sets have 100 * intersection >= percent * union."""
    left = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    right = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))

    def run(batches):
        hashes, last = _Hashes(), (None, None)
        for b in slices(batches, 64):
            keep = []
            for ta, tb in zip(utf8(b, "text_a"), utf8(b, "text_b")):
                if ta != last[0]:
                    last = (ta, shingle_hashes(ta, shingle, hashes))
                y = shingle_hashes(tb, shingle, hashes)
                both = len(np.intersect1d(last[1], y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(last[1]) + len(y) - both))
            yield pa.RecordBatch.from_arrays([column(b, "a"), column(b, "b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "b").join(right, "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (smallest id reachable) of every node of ``edges(a, b)``.

    Each round joins every node to its smallest neighbour (and that one's), and
    contracts the edges: the nodes of a component at least halve, the edges
    within it vanish. A component's smallest id only ever joins itself, so it
    is the one that is left.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "neardup-edges")
    found = None
    while found is None or not both.isEmpty():
        low = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("up"))
        low = low.join(low.toDF("up", "far"), "up").select("id", F.least("up", "far").alias("up"))
        step = written(low, "neardup-step")
        both = written(both.join(step.toDF("a", "up_a"), "a").join(step.toDF("b", "up_b"), "b").where("up_a <> up_b")
                       .select(F.col("up_a").alias("a"), F.col("up_b").alias("b")).distinct(), "neardup-edges")
        step = step.toDF("id", "component")
        found = step if found is None else written(
            found.join(step.toDF("component", "up"), "component", "left").select("id", F.coalesce("up", "component").alias("component")),
            "neardup-labels")
    return found


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``.

    Rows are linked when 100 * intersection >= percent * union of their sets;
    ``component_id`` is the smallest doc_id reachable. Null, empty and blank
    texts have an empty set, are linked with nothing and are kept. A row
    without doc_id is linked with nothing, has a null component and is kept.
    Rows that repeat a doc_id count as one document with all their links. Other
    columns are not looked at; texts of any length are taken whole.
    """
    table = written(sketch(docs, shingle), "neardup-sketch")
    sets = table.where("set_key is not null and doc_id is not null")
    classes = written(sets.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "neardup-class")
    # one row of each class: equal sets have equal samples
    first = classes.select(F.col("set_key").alias("key_of"), "rep")
    reps = written(sets.join(first, (sets.set_key == first.key_of) & (sets.doc_id == first.rep))
                   .select("rep", "bands", "odd").dropDuplicates(["rep", "bands"]), "neardup-reps")
    rows = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = rows.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("high")).where("leader < high")
    members = written(rows.join(shared.select("key", "leader"), "key"), "neardup-buckets")

    odd = reps.select("rep", "odd")
    # members that meet a leader in one or two buckets only are left to the second pass
    star = (members.where("rep <> leader").groupBy(F.col("leader").alias("a"), F.col("rep").alias("b"))
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LED).select("a", "b"))
    tried = written(star.join(odd.toDF("b", "odd_b"), "b").join(odd.toDF("a", "odd_a"), "a").where(_bits("odd_a", "odd_b", SKETCH_WORDS) <= sketch_limit(SAMPLES, SKETCH_WORDS * 64, percent))
                    .select("a", "b"), "neardup-pairs")
    ids = members.select("rep").distinct()
    texts = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                    .join(ids, F.col("doc_id") == F.col("rep"), "left_semi"), "neardup-texts")
    first_links = written(confirmed(tried, texts, shingle, percent), "neardup-links")
    one = components(first_links)

    # what shares a bucket, but not yet a component
    named = members.select("key", "band", "rep").join(one.withColumnRenamed("id", "rep"), "rep", "left").select(
        "key", "band", "rep", F.coalesce("component", "rep").alias("component"))
    named = written(named, "neardup-named")
    mixed = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    open_ = written(named.join(mixed, "key"), "neardup-open")
    sharp = sharp_sketch(texts.join(open_.select("rep").distinct(), F.col("doc_id") == F.col("rep"), "left_semi"), shingle, percent)
    sharp = written(sharp.join(reps.select("rep", "bands").dropDuplicates(["rep"]), "rep"), "neardup-sharp")
    open_ = open_.join(sharp, "rep")
    x = open_.select(*(F.col(c).alias(f"{c}_x" if c != "key" else c) for c in open_.columns))
    y = open_.select(*(F.col(c).alias(f"{c}_y" if c != "key" else c) for c in open_.columns))
    pairs = (x.join(y, (x["key"] == y["key"]) & (F.col("component_x") < F.col("component_y")) & _alike(percent)
                    & _first_meeting("bands_x", "bands_y", F.col("band_x")))
             .select(F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b")).distinct())
    rest = written(pairs.join(tried, ["a", "b"], "left_anti"), "neardup-pairs")
    links = written(confirmed(rest, texts, shingle, percent), "neardup-links")
    # between components, once each; a doc_id that stands for two sets joins their classes
    over = links.join(one.toDF("a", "up_a"), "a", "left").join(one.toDF("b", "up_b"), "b", "left").select(
        F.coalesce("up_a", "a").alias("a"), F.coalesce("up_b", "b").alias("b")).where("a <> b").distinct()
    two = components(over)

    final = classes.join(one.toDF("rep", "up"), "rep", "left").withColumn("up", F.coalesce("up", "rep"))
    final = final.join(two.toDF("up", "top"), "up", "left").withColumn("found", F.coalesce("top", "up"))
    moved = final.where("n > 1 or found <> rep").select(F.col("set_key").alias("key_of"), "found")
    return (table.join(moved, table.set_key == moved.key_of, "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))))


def deduplicated(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, without those that are not kept.

    Rows that repeat a kept doc_id with the same set stay as they are: they are
    that document.
    """
    gone = near_duplicates(docs, shingle, percent).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs.doc_id.cast("long") == F.col("__gone"), "left_anti")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), shingle=2, percent=80)


QUERIES = {"op1_near_duplicates": op1_near_duplicates}
ORACLE = {"op1_near_duplicates": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [w[1]]
           ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s FROM w),
cls AS (SELECT s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY s),
post AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM cls),
pairs AS (SELECT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb, count(*) AS c FROM post a JOIN post b ON a.g = b.g AND a.rep < b.rep
            AND a.n * 100 >= b.n * 80 AND b.n * 100 >= a.n * 80 GROUP BY ALL),
e AS (SELECT a, b FROM pairs WHERE 100 * c >= 80 * (na + nb - c)),
ee AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(id, to_id) AS (SELECT rep, rep FROM cls UNION SELECT r.id, ee.b FROM reach r JOIN ee ON r.to_id = ee.a),
comp AS (SELECT id, min(to_id) AS c FROM reach GROUP BY id)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept
FROM sets LEFT JOIN cls ON sets.s = cls.s LEFT JOIN comp ON cls.rep = comp.id
"""}
