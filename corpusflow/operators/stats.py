"""Corpus and storage statistics (AGG1-AGG3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.text import fmt_mb


def long_sides(df: DataFrame, keys, with_side: bool = False) -> DataFrame:
    """Both sides of a pair table as rows ``(*keys, lang, text)`` (+ ``side`` 1/2).

    ``stack`` in one projection: no union, the input is scanned once.
    """
    out = df.select(*keys, F.expr(
        "stack(2, 1, split_part(langs, '-', 1), source, 2, split_part(langs, '-', 2), target) AS (side, lang, text)"))
    return out if with_side else out.drop("side")


def segment_stats(df: DataFrame, keys=("classifier",)) -> DataFrame:
    """AGG1: sentences and space-split words per key and language, with totals.

    ``rollup`` gives per-(key, lang) rows, per-key subtotals and a grand
    total in one aggregate (the reference keeps only the last file's numbers).
    Words are ``len(text.split(' '))``, as in the reference.
    """
    keys = list(keys)
    sides = long_sides(df, keys)
    return (sides.rollup(*keys, "lang")
            .agg(F.count(F.lit(1)).alias("n_sentences"),
                 F.sum(F.size(F.split("text", " "))).cast("bigint").alias("n_words")))


def file_sizes(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """AGG2: file sizes in MB (10^6 bytes) per directory, with a total row.

    ``binaryFile`` is read with only ``path`` and ``length`` selected, so file
    contents are never loaded. Keyed by full path (the reference keys by base
    name, so equal names collide).
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(root).select("path", "length")
    files = files.withColumn("dir", F.regexp_extract("path", "^(.*)/[^/]+$", 1))
    return (files.rollup("dir")
            .agg(F.count(F.lit(1)).alias("n_files"),
                 F.sum("length").alias("bytes"))
            .withColumn("size_mb", fmt_mb(F.col("bytes") / F.lit(1e6))))


def results_table(scores: DataFrame, segments: DataFrame, sizes: DataFrame | None = None,
                  durations: DataFrame | None = None) -> DataFrame:
    """AGG3: one results row per ``(session, split_n)``.

    ``scores`` is the long score table; metrics are folded into a map so new
    metrics need no schema change.
    """
    folded = scores.groupBy("session", "split_n").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "score")))).alias("scores"))
    out = folded.join(segments, ["session", "split_n"], "left")
    if sizes is not None:
        out = out.join(sizes, ["session", "split_n"], "left")
    if durations is not None:
        out = out.join(durations, ["session", "split_n"], "left")
    return out
