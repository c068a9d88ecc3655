"""Session helpers.

On a cluster the session comes from the launcher; these helpers only fill in
settings that are unset, so a cluster configuration always wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings this library relies on; applied only where the session has none.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "corpusflow") -> SparkSession:
    """Return the active session, or build a local one for tests and bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or os.environ.get("SPARK_MASTER", "local[8]"))
    builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    builder = builder.config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


_LOCAL_FALLBACK: dict = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster sets it to shared storage and it is used as is. Where none is
    configured, a local master (tests) gets a fresh local folder, once per
    application; on a cluster executors would each write to their own disk, so
    there it is an error.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = sc.applicationId
        base = _LOCAL_FALLBACK.get(app)
        if base is None:
            base = _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="corpusflow-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base
