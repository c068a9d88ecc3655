"""Training-log monitor as Structured Streaming (LOG10-LOG13).

``readStream.text`` over the job folders replaces the reference's polling
loop; the file source checkpoint remembers which files were read (LOG10).
Each micro-batch goes through the same chunk-parallel operators as a batch
(:func:`corpusflow.operators.logs.clock`), continued from a carry table of one
row per job (last line time, short gaps, pauses, sentences, GPUs: LOG12), so no
job is gathered into one task and the stream yields exactly the batch result,
wherever batches end. Lines are ordered by file name and line number, as in a
batch.

Logs may arrive as rolled chunks (new files of a job sort after its earlier
ones; the file source reads each file once) or as appends to one file
(``follow``: :mod:`corpusflow.sources.follow` reads on where a batch ended). A
batch that is retried writes its rows and its carry to the same folders anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow.operators import logs as L
from corpusflow.sources.follow import FollowedLogs
from corpusflow.sources.sinks import write_scalars

OUTPUT_SCHEMA = "job string, up long, ts timestamp, gap double, adj_ts double, sen_diff long"


def log_stream(spark: SparkSession, root: str, name: str = "*.log", max_files: int = 4) -> DataFrame:
    """LOG11: lines of every job folder under ``root`` as a stream; job = the
    file's folder (of a ``key=value`` folder its value)."""
    raw = (spark.readStream.option("pathGlobFilter", name).option("recursiveFileLookup", "true")
           .option("maxFilesPerTrigger", max_files).text(root))
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return raw.select(F.regexp_extract(path, r"([^/=]+)/[^/]+$", 1).alias("job"), path.alias("file"),
                      F.col("_metadata.file_block_start").alias("block"), "value")


def followed_stream(spark: SparkSession, root: str, name: str = "*.log", split_bytes: int = 16 << 20) -> DataFrame:
    """LOG10/LOG11: as :func:`log_stream`, reading on in files that were appended to."""
    spark.dataSource.register(FollowedLogs)
    raw = (spark.readStream.format("followed_logs").option("path", root).option("name", name)
           .option("splitBytes", split_bytes).load())
    return raw.select(F.regexp_extract("file", r"([^/=]+)/[^/]+$", 1).alias("job"), "file",
                      F.floor(F.col("start") / split_bytes).alias("block"), F.col("start").alias("at"), "value")


def numbered(batch: DataFrame) -> DataFrame:
    """``job, line_no, value``: lines counted through the job's files of a batch."""
    if "at" not in batch.columns:
        batch = batch.withColumn("at", F.monotonically_increasing_id())  # scan order
    local = batch.withColumn("_pos", F.row_number().over(Window.partitionBy("job", "file", "block").orderBy("at")))
    sizes = batch.groupBy("job", "file", "block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("job").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("job", "file", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return local.join(offsets, ["job", "file", "block"]).select("job", (F.col("_pos") + F.col("_off")).alias("line_no"), "value")


def monitor(spark: SparkSession, root: str, out_path: str, checkpoint: str, name: str = "*.log",
            available_now: bool = True, max_files: int = 4, scalars_path: str | None = None, expire_hours: float | None = None,
            follow: bool = False):
    """LOG10-LOG12: start the monitor; returns the StreamingQuery.

    Rows go to ``out_path/batch=<n>``, scalar series (SNK6) to
    ``scalars_path/batch=<n>`` if given. Jobs without a line for
    ``expire_hours`` of log time are dropped from the carry.
    With ``follow`` files may grow, and a batch takes all that is new.
    ``available_now=True`` drains what is there and stops (tests, backfills);
    otherwise a 5-second processing-time trigger polls like the reference.
    """
    def step(batch: DataFrame, n: int) -> None:
        s = batch.sparkSession
        carry = s.read.schema(L.STATE).parquet(f"{checkpoint}/carry/batch={n - 1}") if n else None
        clocked = L.clock(L.parse_lines(numbered(batch)), carry=carry)
        clocked = clocked.withColumn("sen_diff", F.col("sen_diff").cast("bigint"))
        (clocked.where(F.col("kind").isin("train", "valid")).select("job", "up", "ts", "gap", "adj_ts", "sen_diff")
         .write.mode("overwrite").parquet(f"{out_path}/batch={n}"))
        if scalars_path:
            write_scalars(L.to_scalars(clocked), f"{scalars_path}/batch={n}", "overwrite")
        state = L.carry_of(clocked, carry)
        if expire_hours is not None:
            newest = state.agg(F.max("at").alias("newest"))
            state = state.join(F.broadcast(newest), F.col("at") >= F.col("newest") - F.expr(f"INTERVAL {int(expire_hours * 3600)} SECONDS"), "left_semi")
        state.write.mode("overwrite").parquet(f"{checkpoint}/carry/batch={n}")

    lines = followed_stream(spark, root, name) if follow else log_stream(spark, root, name, max_files)
    writer = (lines.writeStream.foreachBatch(step)
              .option("checkpointLocation", f"{checkpoint}/stream"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    return writer.start()


def read_monitor(spark: SparkSession, out_path: str) -> DataFrame:
    """What the monitor has written so far."""
    return spark.read.schema(OUTPUT_SCHEMA).parquet(out_path)


def drop_seen(stream: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """LOG10: drop lines already seen (same job, kind and update) within the
    watermark; lines older than it are dropped and counted by the state operator."""
    return stream.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["job", "kind", "up"])


def stream_bursts(stream: DataFrame, watermark: str = "1 hour", threshold: int = L.PAUSE_SECONDS) -> DataFrame:
    """LOG13 in a stream: ``job, start_ts, end_ts, n_lines`` of the bursts that
    the watermark has closed. As in a batch, a gap over ``threshold`` seconds
    starts a new burst, one of just that length does not."""
    gap = F.expr(f"INTERVAL {threshold} SECONDS + INTERVAL 1 MICROSECOND")
    return (stream.withWatermark("ts", watermark)
            .groupBy("job", F.session_window("ts", f"{threshold} seconds 1 microseconds").alias("w"))
            .agg(F.count(F.lit(1)).alias("n_lines"))
            .select("job", F.col("w.start").alias("start_ts"), (F.col("w.end") - gap).alias("end_ts"), "n_lines"))


def drain(stream: DataFrame, out_path: str, checkpoint: str) -> int:
    """Append what a stream of events has to say now to Parquet; returns how many
    rows came too late for its state."""
    q = (stream.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
