"""Experiment tables (EXP1-EXP7): appended records, latest state, pivots.

Session and score records are append-only tables; "current" values are
derived with ``max_by`` aggregates, never by rewriting rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- FIXED VALUES: session id grammar ``src-tgt_ident`` ---------------------------
SESSION_RE = r"^([^-_]+)[-_]([^-_]+)_(.+)$"
SCORE_METRICS = ("BLEU", "CHRF", "TER")


def latest_scores(records: DataFrame) -> DataFrame:
    """Latest score per ``(session, split_n, metric)`` from appended records."""
    return (records.groupBy("session", "split_n", "metric")
            .agg(F.max_by("score", "updated_at").alias("score"), F.max("updated_at").alias("updated_at")))


def latest_sessions(records: DataFrame) -> DataFrame:
    """EXP1: newest record per session (ties broken by split_n, metric)."""
    last = F.max_by(F.struct("split_n", "metric", "score"), F.struct("updated_at", "split_n", "metric"))
    return (records.groupBy("session")
            .agg(F.max("updated_at").alias("updated_at"), last.alias("r"))
            .select("session", "updated_at", F.col("r.split_n").alias("split_n"),
                    F.col("r.metric").alias("metric"), F.col("r.score").alias("score")))


def session_states(records: DataFrame) -> DataFrame:
    """EXP1: the state of each session from its appended records.

    ``records(session, kind, value, at, seq)`` with the kinds ``new`` (created),
    ``use`` (made current), ``annotate`` (value = comment) and ``progress``
    (value = trained splits); the latest record of a kind counts, by ``(at,
    seq)``. One aggregate with map-side partial states, no record is rewritten.
    """
    of = lambda kind, c: F.when(F.col("kind") == kind, F.col(c))
    when = lambda kind: F.when(F.col("kind") == kind, F.struct("at", "seq"))
    return records.groupBy("session").agg(
        F.min(of("new", "at")).alias("created"), F.max(of("use", "at")).alias("used"),
        F.max_by(of("annotate", "value"), when("annotate")).alias("comment"),
        F.max_by(of("progress", "value"), when("progress")).try_cast("int").alias("progress"))


def list_sessions(records: DataFrame, n: int = 10) -> DataFrame:
    """EXP2: the n most recently created sessions, newest first; the session
    with the latest record is marked current. Sort, then limit (Q23)."""
    s = records.groupBy("session").agg(F.min("updated_at").alias("created"), F.max("updated_at").alias("last"))
    current = s.agg(F.max_by("session", F.struct("last", "session")).alias("current"))
    top = s.orderBy(F.col("created").desc(), F.col("session")).limit(n)
    # equi-join on a constant key against the one-row side (broadcast)
    return (top.withColumn("_k", F.lit(1)).join(F.broadcast(current.withColumn("_k", F.lit(1))), "_k", "left")
            .select("session", "created", (F.col("session") == F.col("current")).alias("is_current")))


def scores_matrix(latest: DataFrame, metrics=SCORE_METRICS) -> DataFrame:
    """EXP3: one row per (session, split_n), one column per metric."""
    return latest.groupBy("session", "split_n").pivot("metric", list(metrics)).agg(F.first("score"))


def best_split(latest: DataFrame, metric: str = "BLEU") -> DataFrame:
    """EXP4: split with the highest score per session; lowest split on ties (Q18)."""
    m = latest.where(F.col("metric") == metric)
    return m.groupBy("session").agg(
        F.min_by("split_n", F.struct((-F.col("score")).alias("neg"), F.col("split_n"))).alias("best_split"),
        F.max("score").alias("best_score"))


def results(table: DataFrame, full: bool = False) -> DataFrame:
    """EXP5: results with or without the per-file detail columns (Q19)."""
    detail = [c for c in table.columns if c.startswith("detail_")]
    return table if full else table.drop(*detail)


def parse_session_id(c) -> list:
    """EXP6: ``src-tgt_ident`` -> source, target, ident columns."""
    return [F.regexp_extract(c, SESSION_RE, 1).alias("source_lang"),
            F.regexp_extract(c, SESSION_RE, 2).alias("target_lang"),
            F.regexp_extract(c, SESSION_RE, 3).alias("ident")]


def cv_summary(latest: DataFrame) -> DataFrame:
    """EXP7: mean / min / max / sample stddev of each metric over splits."""
    return latest.groupBy("session", "metric").agg(
        F.count(F.lit(1)).alias("n_splits"), F.avg("score").alias("mean"), F.min("score").alias("min"),
        F.max("score").alias("max"), F.stddev_samp("score").alias("stddev"))
