"""Translate-request text preparation and reassembly (TXT9-TXT11, TXT14, SET3).

The model call itself is outside Spark; a caller-supplied table of
translated sentences is joined back by ``(id, pos)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import normalize, rstrip_period, split_sentences


def sentence_rows(df: DataFrame, key: list, text: str = "text") -> DataFrame:
    """TXT9/TXT10: one row per sentence ``(*key, pos, sentence)``; the text is
    normalised with no language (Q24), cut into sentences, and each
    sentence stripped of trailing periods. ``pos`` is 0-based."""
    d = df.select(*key, normalize(F.col(text)).alias("_n"))
    return (d.select(*key, F.posexplode(split_sentences(F.col("_n"))).alias("pos", "_s"))
            .select(*key, F.col("pos").cast("bigint").alias("pos"), rstrip_period(F.col("_s")).alias("sentence")))


def reassemble(sentences: DataFrame, originals: DataFrame, key: list, text: str = "text",
               value: str = "sentence") -> DataFrame:
    """TXT11: join sentences back per key in ``pos`` order; the separator is a
    newline if the original text had one, else two spaces. Every request is
    answered: one without sentences by an empty text, one without text by null."""
    asked = originals.select(*key, F.col(text).isNull().alias("_none"), F.col(text).contains("\n").alias("_lines"))
    g = sentences.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("pos", value))).alias("_parts"))
    # array_join needs a literal separator, so pick one of the two joins
    parts = F.transform("_parts", lambda p: p[value])
    joined = F.when(F.col("_lines"), F.array_join(parts, "\n")).otherwise(F.array_join(parts, "  "))
    return asked.join(g, key, "left").select(*key, F.when(~F.col("_none"), F.coalesce(joined, F.lit(""))).alias("text"))
