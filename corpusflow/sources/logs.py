"""Training-log sources (SRC11, SRC12) for batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.sources.bitext import number_lines


def read_logs(spark: SparkSession, root: str, name: str = "marian.log") -> DataFrame:
    """SRC11: ``job, line_no, value`` from every ``name`` file under ``root``;
    job = the file's parent directory, ``line_no`` the line's number in its file."""
    raw = spark.read.option("pathGlobFilter", name).option("recursiveFileLookup", "true").text(root)
    return number_lines(raw).select(F.regexp_extract("file", r"([^/=]+)/[^/]+$", 1).alias("job"), "line_no", "value")


def read_avg_logs(spark: SparkSession, root: str) -> DataFrame:
    """SRC12: ``avg-*.log`` lines with ``name`` = file name without ``.log``."""
    raw = spark.read.option("pathGlobFilter", "avg-*.log").option("recursiveFileLookup", "true").text(root)
    return number_lines(raw).select(F.regexp_extract("file", r"([^/]+)\.log$", 1).alias("name"), "line_no", "value")


def unseen_steps(parsed: DataFrame, seen: DataFrame) -> DataFrame:
    """SRC12 incremental: keep ``(name, step)`` pairs not reported before."""
    return parsed.join(seen.select("name", "step"), ["name", "step"], "left_anti")
