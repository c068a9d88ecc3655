"""Sentence borders learnt from the corpus (TXT9).

A full stop after an abbreviation ends no sentence. Which words are
abbreviations follows from counts alone: they hardly ever stand without their
full stop (a likelihood ratio of the word and the stop against a word that
meets it by chance), are short, and often hold further full stops. Every
occurrence without a stop counts against a word, the more the longer it is.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.text import normalize, rstrip_period, split_sentences
from corpusflow.operators.vocab import _written

#: share of an abbreviation's occurrences that have their full stop
ALWAYS = 0.99
#: score from which a word is an abbreviation
LEAST_SCORE = 0.3
#: occurrences with a full stop that a word needs
LEAST_COUNT = 5
#: a token: the word in group 1, its full stop in group 2, other punctuation around
WORD = r"^[^\p{L}\p{N}]*(\p{L}(?:[\p{L}.]*\p{L})?)(\.?)[^\p{L}\p{N}.]*$"
#: a token with a full stop: ``WORD`` where that is there
STOPPED = WORD.replace(r"(\.?)", r"\.")
#: abbreviations that are sent to every task; more are joined by a shuffle
MOST_SENT = 200_000
#: different tokens that a task counts before it passes them on, and texts between two looks at their number
MOST_TOKENS, SLICE = 500_000, 256


def token_counts(texts: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, t, n``: the tokens between whitespace (that of ``rules.WS``, which is
    Python's own) as each task counts them, so one token can have several rows."""
    named = texts.select(F.col(lang).alias("lang"), F.col(text).alias("t"))
    schema = T.StructType([named.schema["lang"], T.StructField("t", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches):
        counts = defaultdict(Counter)

        def rows(type_):
            for name, own in counts.items():
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(own), type_), pa.array(own, pa.string()), pa.array(own.values(), pa.int64())],
                                                 names=["lang", "t", "n"])
            counts.clear()

        type_ = None
        for batch in batches:
            type_ = batch.schema.field("lang").type
            for at in range(0, batch.num_rows, SLICE):
                b = batch.slice(at, SLICE)
                for name, t in zip(b.column("lang").to_pylist(), b.column("t").to_pylist()):
                    if t:
                        counts[name].update(t.split())
                if sum(map(len, counts.values())) > MOST_TOKENS:
                    yield from rows(type_)
        yield from rows(type_)

    return named.mapInArrow(run, schema)


def abbreviation_scores(texts: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, word, n_stop, n_free, score``: every word with its occurrences
    with and without a full stop; those of ``abbreviations`` are a filter of it.

    Tokens are counted before they are taken apart and shuffled, so frequent ones cost nothing;
    the totals are one row for each language. Null texts have no words.
    """
    words = token_counts(texts, text, lang).select(
        "lang", F.lower(F.regexp_extract("t", WORD, 1)).alias("word"), "n",
        F.when(F.regexp_extract("t", WORD, 2) == ".", F.col("n")).otherwise(0).alias("stop")).where("word <> ''")
    counts = words.groupBy("lang", "word").agg(F.sum("stop").alias("n_stop"), (F.sum("n") - F.sum("stop")).alias("n_free"))
    every = counts.groupBy("lang").agg((F.sum("n_stop") / F.sum(F.col("n_stop") + F.col("n_free"))).alias("p"))
    # a language without a name is one of its own
    d = counts.join(every.withColumnRenamed("lang", "_l"), F.col("lang").eqNullSafe(F.col("_l"))).drop("_l")
    chance = F.col("n_stop") * F.log("p") + F.col("n_free") * F.log(1 - F.col("p"))
    bound = F.col("n_stop") * F.log(F.lit(ALWAYS)) + F.col("n_free") * F.log(F.lit(1 - ALWAYS))
    letters = F.length(F.replace("word", F.lit(".")))
    inside = F.length("word") - letters + 1
    score = 2 * (bound - chance) * F.exp(-letters) * inside * F.pow(letters.cast("double"), -F.col("n_free").cast("double"))
    # where all or none of the tokens have a stop, there is nothing to tell words by
    return d.select("lang", "word", "n_stop", "n_free",
                    F.when((F.col("p") > 0) & (F.col("p") < 1), F.round(score, 6)).otherwise(0.0).alias("score"))


def abbreviations(scores: DataFrame, least_score: float = LEAST_SCORE, least_count: int = LEAST_COUNT) -> DataFrame:
    """``lang, word`` of the words that are abbreviations."""
    return scores.where((F.col("score") >= least_score) & (F.col("n_stop") >= least_count)).select("lang", "word")


def trained_sentence_rows(df: DataFrame, key: list, abbrevs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """As ``requests.sentence_rows`` (``key`` names a row), but not cut after a
    word of ``abbrevs(lang, word)``; parts that stay together are joined by a space.

    Pieces meet the abbreviations by an equi-join on their last word, where they
    are if there are up to ``MOST_SENT`` of those (they are written and counted
    first); a text's pieces then come together by its key.
    """
    pieces = (df.select(*key, F.col(lang).alias("_lang"), normalize(F.col(text)).alias("_n"))
              .select(*key, "_lang", F.posexplode(split_sentences(F.col("_n"))).alias("_p", "_s")))
    last = F.regexp_extract("_s", r"(\S+)$", 1)
    # empty where the piece ends in no word with a full stop; no abbreviation is
    pieces = pieces.withColumn("_w", F.lower(F.regexp_extract(last, STOPPED, 1)))
    known = _written(abbrevs.select(F.col("lang").alias("_l"), F.col("word").alias("_k"), F.lit(1).alias("_open")).where("_k <> ''"))
    if known.count() <= MOST_SENT:
        known = F.broadcast(known)
    met = pieces.join(known, F.col("_lang").eqNullSafe(F.col("_l")) & (F.col("_w") == F.col("_k")), "left")
    order = Window.partitionBy(*key).orderBy("_p")
    met = met.withColumn("_new", F.when(F.lag("_open").over(order).isNull(), 1).otherwise(0))
    met = met.withColumn("_pos", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    whole = met.groupBy(*key, "_pos").agg(F.array_sort(F.collect_list(F.struct("_p", "_s")))["_s"].alias("_all"))
    return whole.select(*key, F.col("_pos").cast("bigint").alias("pos"), rstrip_period(F.array_join("_all", " ")).alias("sentence"))
