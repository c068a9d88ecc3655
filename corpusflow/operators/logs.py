"""Training-log analytics (LOG1-LOG9, LOG13, SRC12 parsing).

Log lines arrive as ``(job, line_no, value)`` rows, ``line_no`` being the line
number in the job's log (the reference reads lines in file order).

Per-job running quantities (sentence deltas, pause-adjusted wall time,
burst ids) are prefix sums. A window partitioned by job alone would put a
whole job, possibly a third of all rows, into one task; instead every prefix
sum is computed in parallel per (job, chunk of line numbers) and offset by a
prefix over a per-chunk table (:func:`clock`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- FIXED VALUES: log line grammar and monitor rules -------------------------
TS = r"^\[(\d{4}-\d{2}-\d{2})\s+(\d{2}:\d{2}:\d{2})\]\s+"
TRAIN_RE = (TS + r"Ep\.\s+(\d+)\s+:\s+Up\.\s+(\d+)\s+:\s+Sen\.\s+([\d,]+)\s+:\s+Cost\s+([\d.]+)\s+:\s+"
            r"Time\s+([\d.]+)s\s+:\s+([\d.]+)\s+words/s(?:\s+:\s+L\.r\.\s+([\d.]+(?:e[-+]?\d+)?))?")
VALID_RE = (TS + r"\[valid\]\s+Ep\.\s+(\d+)\s+:\s+Up\.\s+(\d+)\s+:\s+(\S+)\s+:\s+([\d.]+)\s+:\s+"
            r"(new best|stalled\s+(\d+))")
DEVICES_RE = r"--devices((?:\s+\d+)+)"
PAUSE_SECONDS = 1200
FINISHED = "finished"
CHUNK_LINES = 1 << 16  # lines per chunk of a parallel prefix sum


def wall_time(line: Column) -> Column:
    """LOG3: the ``[YYYY-MM-DD HH:MM:SS]`` prefix as a timestamp (session TZ)."""
    return F.to_timestamp(F.concat_ws(" ", F.regexp_extract(line, TS, 1), F.regexp_extract(line, TS, 2)),
                          "yyyy-MM-dd HH:mm:ss")


def line_kind(line: Column) -> Column:
    """Classify a line as the reference monitor does."""
    return (F.when(line.contains("--devices"), F.lit("devices"))
            .when(line.contains("] Ep. ") & ~line.contains("[valid]"), F.lit("train"))
            .when(line.contains("[valid]"), F.lit("valid"))
            .when(line.contains(FINISHED), F.lit("finished"))
            .otherwise(F.lit("other")))


FIELD_SEP = "\u0001"


def _fields(line: Column, pattern: str, groups) -> Column:
    """The ``groups`` of ``pattern`` in one run of the regex; one item where it does not match."""
    repl = FIELD_SEP.join(["", *(f"${g}" for g in groups)])
    return F.split(F.regexp_replace(line, pattern + ".*$", repl), FIELD_SEP)


def _typed(fields: str, i: int, kind: str) -> Column:
    return F.nullif(F.try_element_at(F.col(fields), F.lit(i + 1)), F.lit("")).try_cast(kind)


def parse_lines(df: DataFrame, text: str = "value") -> DataFrame:
    """LOG1-LOG4 in one pass: ``job, line_no, kind, ts`` and the typed fields of
    train lines (``epoch, up, sen, cost, time_s, wps, lr``), validation lines
    (``epoch, up, metric, value, stalled``, 0 on ``new best``) and device lines
    (``gpus``). Each line meets one pattern once; unparsable train lines keep
    nulls, unparsable validation lines are kind ``other``.
    """
    line = F.col(text)
    kind = line_kind(line)
    d = df.select("job", "line_no", kind.alias("kind"), wall_time(line).alias("ts"), line.alias("_line"))
    d = d.withColumn("_f", F.when(F.col("kind") == "train", _fields(F.col("_line"), TRAIN_RE, range(3, 10)))
                     .when(F.col("kind") == "valid", _fields(F.col("_line"), VALID_RE, range(3, 9))))
    train, valid = F.col("kind") == "train", F.col("kind") == "valid"
    ids = F.regexp_extract("_line", DEVICES_RE, 1)
    return d.select(
        "job", "line_no", F.when(valid & (F.size("_f") < 2), F.lit("other")).otherwise(F.col("kind")).alias("kind"), "ts",
        _typed("_f", 1, "int").alias("epoch"), _typed("_f", 2, "bigint").alias("up"),
        F.when(train, F.replace(F.try_element_at("_f", F.lit(4)), F.lit(","), F.lit("")).try_cast("bigint")).alias("sen"),
        F.when(train, _typed("_f", 4, "double")).alias("cost"), F.when(train, _typed("_f", 5, "double")).alias("time_s"),
        F.when(train, _typed("_f", 6, "double")).alias("wps"), F.when(train, _typed("_f", 7, "double")).alias("lr"),
        F.when(valid, F.try_element_at("_f", F.lit(4))).alias("metric"), F.when(valid, _typed("_f", 4, "double")).alias("value"),
        F.when(valid, F.when(F.try_element_at("_f", F.lit(6)) == "new best", F.lit(0)).otherwise(_typed("_f", 6, "int"))).alias("stalled"),
        F.when(F.col("kind") == "devices", F.size(F.filter(F.split(F.trim(ids), r"\s+"), lambda x: x != ""))).alias("gpus"))


TRAIN_FIELDS = ["job", "line_no", "ts", "epoch", "up", "sen", "cost", "time_s", "wps", "lr"]
VALID_FIELDS = ["job", "line_no", "ts", "epoch", "up", "metric", "value", "stalled"]


def parse_train(df: DataFrame, text: str = "value") -> DataFrame:
    """LOG1: train lines -> typed fields; unparsable train lines keep nulls."""
    return parse_lines(df, text).where("kind = 'train'").select(*TRAIN_FIELDS)


def parse_valid(df: DataFrame, text: str = "value") -> DataFrame:
    """LOG2: validation lines -> metric, value, stalled (0 on ``new best``)."""
    return parse_lines(df, text).where("kind = 'valid'").select(*VALID_FIELDS)


def gpu_count(df: DataFrame, text: str = "value") -> DataFrame:
    """LOG4: number of integers after ``--devices`` on each devices line."""
    line = F.col(text)
    ids = F.regexp_extract(line, DEVICES_RE, 1)
    return (df.where(line.contains("--devices"))
            .select("job", "line_no", F.size(F.filter(F.split(F.trim(ids), r"\s+"), lambda s: s != "")).alias("gpus")))


# --- parallel prefix sums ----------------------------------------------------------

def carry_forward(df: DataFrame, part: str, order: list, value: str, name: str,
                  chunk: Column | None = None) -> DataFrame:
    """Last non-null ``value`` at or before each row, per ``part``, chunk-parallel."""
    chunk = chunk if chunk is not None else F.floor(F.col("line_no") / CHUNK_LINES)
    d = df.withColumn("_chunk", chunk)
    w = Window.partitionBy(part, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_loc", F.last(value, ignorenulls=True).over(w))
    last = d.groupBy(part, "_chunk").agg(F.max_by(F.col(value), F.when(F.col(value).isNotNull(),
                                                                        F.struct(*order))).alias("_last"))
    wc = Window.partitionBy(part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    prev = last.select(part, "_chunk", F.last("_last", ignorenulls=True).over(wc).alias("_carry"))
    out = d.join(prev, [part, "_chunk"], "left")
    return out.withColumn(name, F.coalesce("_loc", "_carry")).drop("_chunk", "_loc", "_carry")


def with_gpus(lines: DataFrame, train: DataFrame) -> DataFrame:
    """LOG4: each train line with the GPU count of the latest ``--devices``
    line before it in the same job (0 if none)."""
    dev = gpu_count(lines).select("job", "line_no", F.col("gpus").cast("int"))
    tr = train.withColumn("gpus", F.lit(None).cast("int"))
    both = tr.unionByName(dev, allowMissingColumns=True).withColumn("_is_train", F.col("up").isNotNull())
    out = carry_forward(both, "job", ["line_no"], "gpus", "_g")
    return (out.where("_is_train").withColumn("gpus", F.coalesce("_g", F.lit(0)))
            .drop("_g", "_is_train"))


US = 1_000_000


def clock(lines: DataFrame, threshold: int = PAUSE_SECONDS, carry: DataFrame | None = None,
          chunk: Column | None = None) -> DataFrame:
    """LOG5, LOG6, LOG13 and the fields of LOG4 in one chunked pass.

    ``lines`` has ``job, line_no, ts`` and any of ``kind, sen, gpus`` plus what
    else is to be carried. Train and validation lines share one clock (all
    lines, without ``kind``). Adds ``gap`` (seconds since the clock line
    before), ``adj_ts`` (the time in seconds without pauses: of each gap over
    ``threshold`` the excess over the mean of the short gaps so far is taken
    out of every later time; the reference's running mean is miscomputed, Q12,
    this is the true one), ``burst`` (gaps over ``threshold`` so far),
    ``sen_diff`` (sentences since the last train line) and ``gpus_now`` (of the
    latest devices line, 0 if none).

    Per-job running values are prefix sums in two rounds: local ones in each
    (job, chunk of line numbers), and a table of one row per chunk for what
    comes before it, so a job that holds a third of all lines is still spread
    over many tasks. The lines are read, parsed and shuffled once and written
    (reliable ``checkpoint``) before the rounds. Arithmetic is in integer
    microseconds, so the result does not depend on the chunks. ``carry`` (see
    :func:`carry_of`) continues jobs from earlier lines.
    """
    d = lines.withColumns({"_t": F.unix_micros("ts"), "_chunk": chunk if chunk is not None else F.floor(F.col("line_no") / CHUNK_LINES)})
    for c, kind in (("sen", "bigint"), ("gpus", "int")):
        if c not in d.columns:
            d = d.withColumn(c, F.lit(None).cast(kind))
    d = d.withColumn("_c", F.when(F.col("kind").isin("train", "valid"), F.col("_t")) if "kind" in d.columns else F.col("_t"))
    order = Window.partitionBy("job", "_chunk").orderBy("line_no")
    before, upto = (order.rowsBetween(Window.unboundedPreceding, k) for k in (-1, 0))
    d = d.withColumns({"_pt": F.last("_c", ignorenulls=True).over(before), "_psen": F.last("sen", ignorenulls=True).over(before),
                       "_gpus": F.last("gpus", ignorenulls=True).over(upto)})
    limit = threshold * US
    step = F.col("_c") - F.col("_pt")
    d = d.withColumns({"_short": F.when(step <= limit, step), "_long": F.when(step > limit, 1).otherwise(0)})
    d = d.withColumns({"_ls": F.coalesce(F.sum("_short").over(upto), F.lit(0)), "_ln": F.count("_short").over(upto),
                       "_ll": F.sum("_long").over(upto)})
    d = _cut(d)

    at = lambda c: F.when(F.col(c).isNotNull(), F.col("line_no"))
    parts = d.groupBy("job", "_chunk").agg(
        F.min_by("_c", at("_c")).alias("first"), F.max_by("_c", at("_c")).alias("last"), F.max_by("sen", at("sen")).alias("sen"),
        F.max_by("gpus", at("gpus")).alias("gpus"), F.coalesce(F.sum("_short"), F.lit(0)).alias("s"), F.count("_short").alias("n"),
        F.sum("_long").alias("l"))
    if carry is not None:
        parts = parts.unionByName(carry.select("job", F.lit(-1).cast("bigint").alias("_chunk"), F.lit(None).cast("bigint").alias("first"),
                                               F.col("t").alias("last"), "sen", "gpus", "s", "n", "l"))
    earlier = Window.partitionBy("job").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"_et": F.last("last", ignorenulls=True).over(earlier), "_esen": F.last("sen", ignorenulls=True).over(earlier),
                               "_egpus": F.last("gpus", ignorenulls=True).over(earlier)})
    border = F.col("first") - F.col("_et")  # the gap into the chunk
    parts = parts.withColumns({"_bs": F.when(border <= limit, border).otherwise(0), "_bn": F.when(border <= limit, 1).otherwise(0),
                               "_bl": F.when(border > limit, 1).otherwise(0)})
    so_far = lambda own, edge: F.coalesce(F.sum(F.col(own) + F.col(edge)).over(earlier), F.lit(0)) + F.col(edge)
    parts = parts.select("job", "_chunk", "_et", "_esen", "_egpus", so_far("s", "_bs").alias("_es"), so_far("n", "_bn").alias("_en"),
                         so_far("l", "_bl").alias("_el"))

    x = d.join(parts, ["job", "_chunk"])
    gap = F.col("_c") - F.coalesce("_pt", "_et")
    # lines before the chunk's first clock line are not past its border
    inside = F.col("_c").isNotNull()
    x = x.withColumns({"_gap": gap, "_n": F.col("_ln") + F.col("_en"), "_s": F.col("_ls") + F.col("_es"),
                       "burst": F.when(inside, F.col("_ll") + F.col("_el")).cast("bigint")})
    mean = F.when(F.col("_n") > 0, F.round(F.col("_s") / F.col("_n"))).otherwise(F.lit(0)).cast("bigint")
    x = x.withColumn("_out", F.when(F.col("_gap") > limit, F.col("_gap") - mean).otherwise(F.lit(0)))
    out = x.groupBy("job", "_chunk").agg(F.sum("_out").alias("o"))
    if carry is not None:
        out = out.unionByName(carry.select("job", F.lit(-1).cast("bigint").alias("_chunk"), F.col("g").alias("o")))
    out = out.select("job", "_chunk", F.coalesce(F.sum("o").over(earlier), F.lit(0)).alias("_eg"))
    x = x.withColumn("_lg", F.sum("_out").over(upto)).join(out, ["job", "_chunk"])
    x = x.withColumns({
        "_g": F.col("_lg") + F.col("_eg"), "gap": F.col("_gap") / F.lit(float(US)),
        "sen_diff": F.col("sen") - F.coalesce("_psen", "_esen", F.lit(0)), "gpus_now": F.coalesce("_gpus", "_egpus", F.lit(0))})
    x = x.withColumn("adj_ts", (F.col("_c") - F.col("_g")) / F.lit(float(US)))
    return x.drop("_t", "_chunk", "_pt", "_psen", "_gpus", "_short", "_long", "_ls", "_ln", "_ll", "_et", "_esen", "_egpus", "_es", "_en",
                  "_el", "_gap", "_out", "_lg", "_eg")


STATE = "job string, t bigint, s bigint, n bigint, l bigint, g bigint, sen bigint, gpus int, at timestamp"


def carry_of(clocked: DataFrame, carry: DataFrame | None = None) -> DataFrame:
    """One row per job to continue :func:`clock` from: the last line's time, the
    sum and number of short gaps, pauses, time taken out, sentences, GPUs."""
    at = lambda c: F.when(F.col(c).isNotNull(), F.col("line_no"))
    last = lambda c: F.max_by(F.when(F.col("_c").isNotNull(), F.col(c)), at("_c"))
    new = clocked.groupBy("job").agg(
        F.max_by("_c", at("_c")).alias("t"), last("_s").alias("s"), last("_n").cast("bigint").alias("n"), last("burst").alias("l"),
        last("_g").alias("g"), F.max_by("sen", at("sen")).alias("sen"), F.max_by("gpus", at("gpus")).alias("gpus"), F.max("ts").alias("at"))
    if carry is None:
        return new.select(*(f.split(" ")[0] for f in STATE.split(", ")))
    old = carry.select(F.col("job").alias("_job"), *(F.col(c).alias(f"_o{c}") for c in ("t", "s", "n", "l", "g", "sen", "gpus", "at")))
    both = new.join(old, F.col("job") == F.col("_job"), "full")
    return both.select(F.coalesce("job", "_job").alias("job"),
                       *(F.coalesce(c, f"_o{c}").alias(c) for c in ("t", "s", "n", "l", "g", "sen", "gpus", "at")))


def _cut(df: DataFrame) -> DataFrame:
    """Write a stage once (reliable ``checkpoint`` into ``spark.checkpoint.dir``):
    it is read for the per-chunk table and for the rows."""
    from corpusflow.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def sentences_diff(train: DataFrame) -> DataFrame:
    """LOG5: sentences since the previous train line of the job (first from 0)."""
    return clock(train).select(*train.columns, "sen_diff")


def pause_adjusted(lines: DataFrame, threshold: int = PAUSE_SECONDS) -> DataFrame:
    """LOG6: wall time minus pauses: ``job, line_no, ts`` plus ``gap``, ``adj_ts``."""
    return clock(lines, threshold).select(*lines.columns, "gap", "adj_ts")


def bursts(lines: DataFrame, threshold: int = PAUSE_SECONDS) -> DataFrame:
    """LOG13: active bursts per job: a gap over ``threshold`` starts a new one."""
    return (clock(lines, threshold).where(F.col("burst").isNotNull()).groupBy("job", "burst")
            .agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count(F.lit(1)).alias("n_lines")))


def duration_hours(lines: DataFrame) -> DataFrame:
    """LOG8: hours from the first line to the ``finished`` line, or -1.

    Full duration (the reference drops whole days, Q10) over the whole log
    (the reference looks at the last 1,024 characters only, Q11).
    """
    ts = wall_time(F.col("value"))
    first = F.min_by(ts, F.col("line_no"))
    end = F.max_by(F.when(F.col("value").contains(FINISHED), ts), F.when(F.col("value").contains(FINISHED), F.col("line_no")))
    g = lines.groupBy("job").agg(first.alias("start_ts"), end.alias("end_ts"))
    hours = (F.col("end_ts").cast("double") - F.col("start_ts").cast("double")) / 3600.0
    return g.select("job", F.coalesce(hours, F.lit(-1.0)).alias("hours"))


def best_update(valid: DataFrame, metric: str = "bleu-detok") -> DataFrame:
    """LOG9: update with the highest value of ``metric`` per job (first on ties)."""
    v = valid.where(F.col("metric") == metric)
    return v.groupBy("job").agg(F.max_by("up", F.struct(F.col("value"), -F.col("line_no"))).alias("best_up"),
                                F.max("value").alias("best_value"))


def to_scalars(clocked: DataFrame) -> DataFrame:
    """LOG7: long scalar rows ``(job, tag, step, wall_time, value)`` of
    :func:`clock` over :func:`parse_lines`: one projection, no self-join."""
    row = lambda tag, value, wall="adj_ts": F.struct(
        (tag if isinstance(tag, Column) else F.lit(tag)).alias("tag"), F.col(wall).cast("double").alias("wall_time"),
        F.col(value).cast("double").alias("value"))
    train = [row("train/epoch", "epoch"), row("train/sentences", "sen"), row("train/sentences-diff", "sen_diff"), row("train/cost", "cost"),
             row("train/time[sec]", "time_s"), row("train/speed[words per sec]", "wps"), row("train/learning_rate", "lr"),
             row("train/gpus", "gpus_now"), row("train/wall-clock", "ts", "ts")]
    name = F.concat(F.lit("valid/"), F.col("metric"))
    valid = [row(name, "value"), row(F.concat(name, F.lit("_stalled")), "stalled")]
    rows = F.when(F.col("kind") == "train", F.array(*train)).otherwise(F.array(*valid))
    return (clocked.where(F.col("kind").isin("train", "valid"))
            .select("job", F.col("up").alias("step"), F.inline(rows)).select("job", "tag", "step", "wall_time", "value"))


def avg_scalars(parsed: DataFrame) -> DataFrame:
    """LOG7: ``valid-avg/<name>_bleu`` rows of :func:`parse_avg_logs`; they have no time."""
    return parsed.select(F.lit(None).cast("string").alias("job"), F.concat(F.lit("valid-avg/"), F.col("name"), F.lit("_bleu")).alias("tag"),
                         "step", F.lit(None).cast("double").alias("wall_time"), F.col("score").alias("value"))


def parse_avg_logs(df: DataFrame, text: str = "value") -> DataFrame:
    """SRC12: ``avg-*.log`` lines ``x-y-<step> <score>`` -> (name, step, score).

    Lines without a numeric third ``-`` field or without a score are skipped.
    """
    parts = F.split(F.trim(F.col(text)), r"\s+")
    label = F.try_element_at(parts, F.lit(1))
    step = F.try_element_at(F.split(label, "-"), F.lit(3)).try_cast("bigint")
    sc = F.try_element_at(parts, F.lit(2)).try_cast("double")
    return (df.select("name", "line_no", step.alias("step"), sc.alias("score"))
            .where(F.col("step").isNotNull() & F.col("score").isNotNull()))
