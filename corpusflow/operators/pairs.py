"""De-duplication, set operations and the joins of the reference (DED, JOI, SET)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIR_KEY = ["source", "target", "classifier", "langs"]


def dedup_rows(df: DataFrame) -> DataFrame:
    """DED1: drop rows equal on every column (with a ``source_path`` column: per file).

    A hash aggregate with map-side partial aggregation: repeated boilerplate
    rows collapse before the shuffle.
    """
    return df.dropDuplicates()


def dedup_pairs(df: DataFrame, key=PAIR_KEY) -> DataFrame:
    """DED2: one row per ``(source, target, classifier, langs)``.

    The id is a hash of classifier, source and target, so all rows of a key
    share it; ``min(id)`` makes the kept value explicit anyway. Other columns
    come from the row with the smallest ``id`` then original order is not
    used, which keeps the result independent of partitioning.
    """
    others = [c for c in df.columns if c not in key]
    if not others:
        return df.dropDuplicates(key)
    if others == ["id"]:
        return df.groupBy(*key).agg(F.min("id").alias("id")).select(*df.columns)
    # keep the whole row with the least (id, other columns) per key
    packed = F.min(F.struct(*[F.col(c) for c in others])).alias("_row")
    return df.groupBy(*key).agg(packed).select(*key, "_row.*").select(*df.columns)


def ensure_unique(test: DataFrame, train: DataFrame, on=("source", "target")) -> DataFrame:
    """JOI1: remove from ``test`` every row whose ``(source, target)`` is in train.

    One left-anti join (the reference merges twice with indicators). AQE
    turns it into a broadcast join at run time when train is small, else a
    sort-merge join on the text key.
    """
    keys = train.select(*on).dropDuplicates()
    return test.join(keys, list(on), "left_anti")


def union_all(frames) -> DataFrame:
    """SET1/SET2: concatenate frames by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def join_triples(src: DataFrame, ref: DataFrame, hyp: DataFrame, key=("line_no",), normalize: bool = True) -> DataFrame:
    """JOI2/JOI3: ``*key, src, ref, hyp``; a repeated source keeps its last line.

    Inputs are line tables ``(*key, text)``; ``key`` orders and identifies the
    lines. Lines are normalised first (TXT5, no language rules), so a source
    is repeated when its normalised text is; of its lines the last counts.
    """
    from corpusflow.functions.text import normalize_columns
    key = list(key)
    sides = {}
    for name, df in (("src", src), ("ref", ref), ("hyp", hyp)):
        df = df.select(*key, F.col("text").alias(name))
        sides[name] = normalize_columns(df, [(name, None)]) if normalize else df
    last = sides["src"].groupBy("src").agg(F.max(F.struct(*key)).alias("_k")).select("_k.*", "src")
    return last.join(sides["ref"], key).join(sides["hyp"], key).select(*key, "src", "ref", "hyp")


def live_sessions(sessions: DataFrame, dirs: DataFrame) -> DataFrame:
    """JOI4: sessions whose directory is still present (``dirs.session``)."""
    return sessions.join(dirs.select("session").distinct(), "session", "left_semi")


def zip_splits(train_inv: DataFrame, valid_inv: DataFrame) -> DataFrame:
    """JOI5: train and valid split files side by side by split number."""
    t = train_inv.select("split_n", F.col("path").alias("train_path"))
    v = valid_inv.select("split_n", F.col("path").alias("valid_path"))
    return t.join(v, "split_n", "inner")


def pending_splits(inventory: DataFrame, results: DataFrame) -> DataFrame:
    """JOI6: splits of a session that have no result yet."""
    done = results.select("session", "split_n").distinct()
    return inventory.join(done, ["session", "split_n"], "left_anti")


def distinct_requests(df: DataFrame, key=("text", "source_lang", "target_lang"), order=("id",)) -> DataFrame:
    """SET3: one request per distinct ``key``: the first by ``order``."""
    order = list(order)
    first = df.groupBy(*key).agg(F.min(F.struct(*order)).alias("_f"))
    return first.select(*key, "_f.*")


def answer_requests(df: DataFrame, answers: DataFrame, key=("text", "source_lang", "target_lang")) -> DataFrame:
    """SET3: the answers of the distinct requests joined back to all requests."""
    return df.join(answers, list(key), "left")
