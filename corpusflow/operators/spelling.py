"""Spelling as table joins (SPL1-SPL4, FLT7).

The reference asks a per-word dictionary library. Here the lexicon is a
``(lang, word)`` table and a misspelling is a token with no lexicon match
under the dictionary case rule, found by one anti-join. AQE broadcasts the
lexicon when its measured size is under the threshold and falls back to a
sort-merge join otherwise, so no size assumption is baked in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import alpha_tokens
from corpusflow.operators.affixes import AffixDictionary
from corpusflow.operators.stats import long_sides
from corpusflow.operators.vocab import _written

DEFAULT_MIN_DOCS = 3


def build_lexicon(df: DataFrame, min_docs: int = DEFAULT_MIN_DOCS, doc: str = "doc_id",
                  lang: str = "lang", text: str = "text") -> DataFrame:
    """SPL1: lower-cased words seen in at least ``min_docs`` documents of a language.

    Each document's words are made distinct inside its row, so counting
    documents per word is one shuffle with map-side partial counts. A document
    is a row; rows that repeat a ``doc`` must be merged before.
    """
    words = F.array_distinct(F.transform(alpha_tokens(F.col(text), F.col(lang)), lambda w: F.lower(w)))
    return (df.select(F.col(lang).alias("lang"), F.explode(words).alias("word"))
            .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n_docs"))
            .where(F.col("n_docs") >= min_docs).select("lang", "word"))


def lookup_form(w) -> F.Column:
    """Dictionary case rule against a lower-case lexicon.

    Capitalised and UPPER words are looked up lower-cased; any other word
    (lower case or mixed) must match exactly.
    """
    cap = F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))
    return F.when((w == F.upper(w)) | (w == cap), F.lower(w)).otherwise(w)


def tokens(pairs: DataFrame, keys=("id",), with_side: bool = False) -> DataFrame:
    """Both sides of a pair table as ``(*keys, lang, word)`` token rows."""
    sides = long_sides(pairs, list(keys), with_side)
    extra = ["side"] if with_side else []
    return sides.select(*keys, *extra, "lang", F.explode(alpha_tokens(F.col("text"), F.col("lang"))).alias("word"))


def unknown_words(toks: DataFrame, lexicon: DataFrame | AffixDictionary) -> DataFrame:
    """``lang, word, n`` of the distinct words of ``toks`` without a lexicon entry.

    Repeats collapse map-side first, so a frequent word meets the lexicon once.
    ``lexicon`` is a table ``lang, word`` or an affix dictionary.
    """
    if isinstance(lexicon, AffixDictionary):
        return lexicon.unknown(toks)
    words = toks.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).withColumn("_form", lookup_form(F.col("word")))
    return words.join(lexicon.select("lang", F.col("word").alias("_form")), ["lang", "_form"], "left_anti").drop("_form")


def misspelt_words(pairs: DataFrame, lexicon: DataFrame | AffixDictionary, keys=("id",), short_circuit: bool = False) -> DataFrame:
    """SPL2: every token with no lexicon entry, ``(*keys, lang, word)``.

    The distinct words are checked; tokens are then held to the unknown ones by
    a semi-join. ``short_circuit=True`` reproduces the reference's count (Q4):
    when the source side has a misspelling, the target side is not checked, so
    its words are not counted (an anti-join of those ids on target tokens).
    """
    # read for the words and for the tokens, so the pairs are made once
    toks = tokens(_written(pairs.select(*keys, "langs", "source", "target")), keys, with_side=True)
    bad = toks.join(unknown_words(toks, lexicon).select("lang", "word"), ["lang", "word"], "left_semi")
    if short_circuit:
        src_bad = bad.where(F.col("side") == 1).select(*keys).distinct()
        bad = bad.where(F.col("side") == 1).unionByName(
            bad.where(F.col("side") == 2).join(src_bad, list(keys), "left_anti"))
    return bad.drop("side")


def misspelt_sentences(bad: DataFrame, key: str = "id") -> DataFrame:
    """SPL3: per sentence, its distinct misspelt words joined by ``', '`` (sorted)."""
    return (bad.groupBy("lang", F.col(key).alias("translation_id"))
            .agg(F.array_join(F.array_sort(F.collect_set("word")), ", ").alias("words")))


def misspelt_counts(bad: DataFrame, by=("lang",)) -> DataFrame:
    """SPL4: occurrences of each misspelt word per language (and source path)."""
    return bad.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("count"))


def misspelt_ids(pairs: DataFrame, lexicon: DataFrame, keys=("id",), short_circuit: bool = False) -> DataFrame:
    """Keys of pairs with a misspelling on either side (FLT7 input).

    ``short_circuit`` is accepted for API parity: the set of bad ids is the
    same either way; only the word counts differ (see ``misspelt_words``).
    """
    return misspelt_words(pairs, lexicon, keys).select(*keys).distinct()


def spelling_gate(pairs: DataFrame, lexicon: DataFrame, keys=("id",)) -> DataFrame:
    """FLT7: drop every pair with a misspelt word on either side."""
    return pairs.join(misspelt_ids(pairs, lexicon, keys), list(keys), "left_anti")
