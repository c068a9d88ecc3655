"""Pair cleaning: FLT1-FLT9.

The reference drops units silently inside a per-file generator; here every
unit gets a ``reject_reason`` (null when kept), computed in one projection, and
the table joins (language check, spelling) run only on rows that survived the
cheap text filters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import rules as R
from corpusflow.functions.text import langs_label, normalize_columns, py_strip, translation_id

# --- FIXED VALUES: reject reasons, in the order they are tested --------------
NOT_IN_PAIR = "not_in_pair"
SAME_LANGUAGE = "same_language"
NULL_TEXT = "null_text"
LEADER_CHARS = "leader_chars"
LANG_MISMATCH = "lang_mismatch"
SUSPICIOUS = "suspicious"
MISSPELT = "misspelt"


def pair_list(langs) -> list[tuple[str, str]]:
    """One pair ``(a, b)``, or several, as a list of pairs."""
    return [tuple(langs)] if isinstance(langs[0], str) else [tuple(p) for p in langs]


def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def in_pair(src_lang: Column, tgt_lang: Column, langs) -> Column:
    """FLT1: both unit languages belong to the pair (to one of the pairs)."""
    return _any(src_lang.isin(*p) & tgt_lang.isin(*p) for p in pair_list(langs))


def has_leader_chars(c: Column) -> Column:
    """FLT4: text starts with two or more of ``_ - .``."""
    return c.rlike(R.LEADER_PATTERN)


def is_suspicious(c: Column, langs) -> Column:
    """FLT6: the stripped text is itself a language code of the pair."""
    return py_strip(c).isin(*langs)


def orient(df: DataFrame, langs) -> DataFrame:
    """FLT2: swap sides so that ``source_lang`` is the pair's source."""
    swap = _any((F.col("source_lang") == b) & (F.col("target_lang") == a) & F.lit(a != b) for a, b in pair_list(langs))
    return df.select(
        *[c for c in df.columns if c not in ("source", "target", "source_lang", "target_lang")],
        F.when(swap, F.col("target")).otherwise(F.col("source")).alias("source"),
        F.when(swap, F.col("source")).otherwise(F.col("target")).alias("target"),
        F.when(swap, F.col("target_lang")).otherwise(F.col("source_lang")).alias("source_lang"),
        F.when(swap, F.col("source_lang")).otherwise(F.col("target_lang")).alias("target_lang"),
    )


def text_checks(units: DataFrame, langs, keep_rejects: bool = True) -> DataFrame:
    """FLT1-FLT4, FLT6 and TXT5 in one projection.

    Input: ``source, target, source_lang, target_lang`` plus any other
    columns (kept). ``langs`` is one language pair or several: with several,
    the units of all pairs are cleaned in one pass, each by its own languages.
    Output adds ``reject_reason``; ``source``/``target`` are normalised with
    their own language.
    """
    many = pair_list(langs)
    # a pair of one language with itself has no "same language" reject
    apart = [p for p in many if p[0] != p[1]]
    same = (F.col("source_lang") == F.col("target_lang")) & F.lit(len(apart) == len(many))
    if not keep_rejects:
        # only candidates: the language test is a plain IN filter on the
        # input columns, so Catalyst pushes it into the scan (row-group skipping)
        cand = in_pair(F.col("source_lang"), F.col("target_lang"), many)
        if len(apart) == len(many):
            cand = cand & (F.col("source_lang") != F.col("target_lang"))
        units = units.where(cand)
    df = orient(units, many)
    # With one pair, every unit that can be kept has exactly its languages, so
    # the language rules are fixed while the plan is built: far less generated
    # code than choosing rules per row, as several pairs need.
    sides = many[0] if len(many) == 1 else (F.col("source_lang"), F.col("target_lang"))
    df = normalize_columns(df, [("source", sides[0]), ("target", sides[1])])
    # The normalised texts come out of a one-row ``inline``: later filters on
    # them (e.g. ``reject_reason IS NULL``) cannot be pushed below it, which
    # would copy the whole rule chain into the filter condition.
    others = [c for c in df.columns if c not in ("source", "target")]
    df = df.select(*others, F.inline(F.array(F.struct(F.col("source").alias("source"),
                                                      F.col("target").alias("target")))))
    codes = many[0] if len(many) == 1 else (F.col("source_lang"), F.col("target_lang"))
    reason = (
        F.when(~in_pair(F.col("source_lang"), F.col("target_lang"), many), F.lit(NOT_IN_PAIR))
        .when(same, F.lit(SAME_LANGUAGE))
        .when(F.col("source").isNull() | F.col("target").isNull(), F.lit(NULL_TEXT))
        .when(has_leader_chars(F.col("source")) | has_leader_chars(F.col("target")), F.lit(LEADER_CHARS))
        .when(is_suspicious(F.col("source"), codes) | is_suspicious(F.col("target"), codes), F.lit(SUSPICIOUS))
    )
    return df.withColumn("reject_reason", reason)


def with_translation(df: DataFrame, classifier: str = "classifier") -> DataFrame:
    """TXT15: add ``id`` and ``langs`` (``src-tgt``)."""
    return df.withColumns({
        "langs": langs_label(F.col("source_lang"), F.col("target_lang")),
        "id": translation_id(classifier, "source", "target"),
    })


def clean(units: DataFrame, langs, lexicon: DataFrame | None = None,
          profile: DataFrame | None = None, short_circuit: bool = False,
          checkpoint: bool = True, keep_rejects: bool = True) -> DataFrame:
    """Full cleaning (FLT1-FLT9): every unit with its ``reject_reason``.

    ``profile`` (LID1 output) enables the language gate FLT5; ``lexicon``
    (SPL1 output) enables the spelling gate FLT7. Both are joins against
    tables, run only on units that passed the text checks. The checked units
    feed the gates and the final join, so with a gate they are written once
    (``checkpoint``); units are matched by the whole 128-bit hash of
    classifier and texts, not by the 60-bit id.
    """
    from corpusflow.operators import langid, spelling

    checked = with_translation(text_checks(units, langs, keep_rejects))
    if profile is None and lexicon is None:
        return checked
    checked = checked.withColumn("_key", F.md5(F.concat_ws("\x1f", "classifier", "langs", "source", "target")))
    if checkpoint:
        from corpusflow.session import checkpoint_dir
        checkpoint_dir(checked.sparkSession)
        checked = checked.checkpoint()
    passed = checked.where(F.col("reject_reason").isNull())
    flags = []
    if profile is not None:
        flags.append(langid.mismatched(passed, profile, ("_key",)).select("_key", F.lit(1).alias("_rank"), F.lit(LANG_MISMATCH).alias("_flag")))
    if lexicon is not None:
        bad = spelling.misspelt_ids(passed, lexicon, ("_key",), short_circuit=short_circuit)
        flags.append(bad.select("_key", F.lit(2).alias("_rank"), F.lit(MISSPELT).alias("_flag")))
    flag = reduce(DataFrame.unionByName, flags)
    # one flag per unit: the language gate comes before the spelling gate
    flag = flag.groupBy("_key").agg(F.min_by("_flag", "_rank").alias("_flag"))
    out = checked.join(flag, "_key", "left")
    return (out.withColumn("reject_reason", F.coalesce(F.col("reject_reason"), F.col("_flag")))
            .drop("_flag", "_key"))


def accepted(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(F.col("reject_reason").isNull()).drop("reject_reason")


def clean_pairs(units: DataFrame, langs, lexicon: DataFrame | None = None,
                profile: DataFrame | None = None) -> DataFrame:
    """Accepted pairs only: rejected units are never normalised, and the
    language-pair test reaches the scan as a pushed filter."""
    return accepted(clean(units, langs, lexicon=lexicon, profile=profile, keep_rejects=False))


def reject_counts(cleaned: DataFrame) -> DataFrame:
    """FLT9: number of units per reject reason (``kept`` for accepted)."""
    return (cleaned.groupBy(F.coalesce(F.col("reject_reason"), F.lit("kept")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))


def drop_nulls(df: DataFrame) -> DataFrame:
    """FLT8: drop any row with a null."""
    return df.dropna(how="any")
