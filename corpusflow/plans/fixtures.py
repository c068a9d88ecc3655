"""Derived test inputs (F1-F7) built lazily from the driver tables.

Each builder is a pure DataFrame transformation of the given tables, so its
work grows with them; the matching SQL in :mod:`corpusflow.plans.oracle`
repeats it in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.text import translation_id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. A launcher that knows its files hold few row groups may
    set ``corpusflow.scanPartitions``; unset (the default) nothing is moved."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    n = spark.conf.get("corpusflow.scanPartitions", None)
    return df.repartition(int(n)) if n else df


# --- FIXED VALUES: classifier labels by source -------------------------------
HEALTH_SOURCES = ("src0", "src1", "src2", "src3", "src4")
OTHER_SOURCES = ("src19",)


def classifier_of(source_col) -> F.Column:
    return (F.when(source_col.isin(*HEALTH_SOURCES), F.lit("Health"))
            .when(source_col.isin(*OTHER_SOURCES), F.lit("Other"))
            .otherwise(F.lit("Unknown")))


def line_pairs(documents: DataFrame) -> DataFrame:
    """line i of a document is the source, line i+1 the target.

    Built with array slicing inside each row, so no shuffle and no window:
    a document never leaves the task that read it.
    """
    lines = F.col("_lines")  # a column, so the lambda does not re-split per element
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(lines) - 1),
        lambda i: F.struct(i.cast("bigint").alias("line_no"),
                           F.element_at(lines, i).alias("source"),
                           F.element_at(lines, i + 1).alias("target")))
    return (documents.withColumn("_lines", F.split(F.col("text"), "\n"))
            .where(F.size(lines) > 1)
            .select("doc_id", "lang", classifier_of(F.col("source")).alias("classifier"),
                    F.inline(pairs))
            .select("doc_id", "line_no", "classifier", "source", "target",
                    F.col("lang").alias("source_lang"), F.col("lang").alias("target_lang"),
                    F.concat_ws("-", F.col("lang"), F.col("lang")).alias("langs")))


def corpus(documents: DataFrame) -> DataFrame:
    """F1 as a Translation table: ``id, classifier, source, target, langs``."""
    f1 = line_pairs(documents)
    return f1.select(translation_id("classifier", "source", "target").alias("id"),
                     "classifier", "source", "target", "langs")


def turn_pairs(conversations: DataFrame) -> DataFrame:
    """a user turn joined to the assistant turn that follows it."""
    u = conversations.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("source"))
    a = conversations.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("target"))
    return u.join(a, ["conv_id", "turn"], "inner")


# --- FIXED VALUES: two-language fixture and triple fixture shape --------------
UNIT_PAIRS = (("en", "fr"), ("en", "de"), ("fr", "de"))
CODE_ONLY = (11, 7)   # every 11th unit (offset 7) has its language code as source
LEADER = (13, 5)      # every 13th unit (offset 5) has a target that starts with a leader
HYP_DROP_EVERY = 7


def units(documents: DataFrame) -> DataFrame:
    """F1b: line i of a document beside line i of the next one (doc_id + 1).

    Documents of different languages give units of every language order, of
    languages outside ``UNIT_PAIRS`` and of one language twice; the shorter
    document leaves null sides. So every reject reason of the cleaning occurs.
    """
    lines = F.split(F.col("text"), "\n")
    a = documents.select("doc_id", F.col("lang").alias("source_lang"), classifier_of(F.col("source")).alias("classifier"),
                         lines.alias("s"))
    b = documents.select((F.col("doc_id") - 1).alias("doc_id"), F.col("lang").alias("target_lang"), lines.alias("t"))
    both = a.join(b, "doc_id").select("doc_id", "classifier", "source_lang", "target_lang", F.posexplode(F.arrays_zip("s", "t")))
    n = F.col("doc_id") + F.col("pos") + 1
    return both.select(
        "doc_id", (F.col("pos") + 1).cast("bigint").alias("line_no"), "classifier", "source_lang", "target_lang",
        F.when(n % CODE_ONLY[0] == CODE_ONLY[1], F.col("source_lang")).otherwise(F.col("col.s")).alias("source"),
        F.when(n % LEADER[0] == LEADER[1], F.concat(F.lit("-- "), F.col("col.t"))).otherwise(F.col("col.t")).alias("target"))


#: abbreviations written into the documents: after this word comes that one
SHORT_AFTER = ((" in ", " in cf. "), (" by ", " by approx. "), (" de ", " de p.ex. "), (" der ", " der z.B. "), (" la ", " la No. "))


def shortened(documents: DataFrame) -> DataFrame:
    """The documents with abbreviations in their lines."""
    text = F.col("text")
    for word, both in SHORT_AFTER:
        text = F.replace(text, F.lit(word), F.lit(both))
    return documents.select("doc_id", "lang", text.alias("text"))


def triples(documents: DataFrame) -> DataFrame:
    """``doc_id, line_no, src, ref, hyp`` from all F1 lines; ``hyp`` is
    ``ref`` without every 7th space-separated word."""
    kept = F.filter(F.split(F.col("target"), " "), lambda w, i: (i + 1) % HYP_DROP_EVERY != 0)
    return line_pairs(documents).select("doc_id", "line_no", F.col("source").alias("src"), F.col("target").alias("ref"),
                                        F.array_join(kept, " ").alias("hyp"))


def edited(documents: DataFrame) -> DataFrame:
    """F5b: ``doc_id, line_no, kind, ref, hyp`` with a known edit in each hypothesis.

    ``ref`` are the distinct a-z words of an F1 line that has one; by ``kind``
    the last word (0) or, of 7 words or more, the last three (4) move to the
    front, the first word is replaced (1), the last one is missing (2), or one
    is added (3). Lines of over 50 words move nothing.
    """
    w, n = F.col("w"), F.size("w")
    front = lambda k: F.concat(F.slice(w, n - k + 1, F.lit(k)), F.slice(w, F.lit(1), n - k))
    kind = (F.col("doc_id") + F.col("line_no")) % 5
    hyp = (F.when((kind == 0) & (n <= 50), front(1)).when((kind == 4) & (n >= 7) & (n <= 50), front(3))
           .when(kind == 1, F.concat(F.array(F.lit("0")), F.slice(w, F.lit(2), n))).when(kind == 2, F.slice(w, F.lit(1), n - 1))
           .when(kind == 3, F.concat(w, F.array(F.lit("1")))).otherwise(w))
    words = F.array_distinct(F.regexp_extract_all("target", F.lit("[a-z]+"), 0))
    return (line_pairs(documents).select("doc_id", "line_no", words.alias("w")).where(F.size("w") > 0)
            .select("doc_id", "line_no", kind.cast("int").alias("kind"), F.array_join(w, " ").alias("ref"), F.array_join(hyp, " ").alias("hyp")))


# FIXED VALUES: rules of the affix dictionary F9
AFFIX_RULES = """SET UTF-8
PFX R Y 1
PFX R 0 re .
SFX S Y 2
SFX S 0 s [^sy]
SFX S y ies y
SFX G N 2
SFX G e ing e
SFX G 0 ing [^e]
COMPOUNDFLAG C
COMPOUNDMIN 3
FORBIDDENWORD !
"""


def dictionary_lines(lexicon: DataFrame) -> DataFrame:
    """``lang, value`` lines of a ``.dic`` file: the lexicon's words, flags by
    length and first letter (R: even length, S: first letter of even code, G:
    length a multiple of 3, C: of 4, !: of 11)."""
    n = F.length("word")
    flags = F.concat_ws("", F.when(n % 2 == 0, "R"), F.when(F.ascii("word") % 2 == 0, "S"), F.when(n % 3 == 0, "G"),
                        F.when(n % 4 == 0, "C"), F.when(n % 11 == 0, "!"))
    return lexicon.select("lang", F.when(flags == "", F.col("word")).otherwise(F.concat_ws("/", "word", flags)).alias("value"))


def word_forms(lexicon: DataFrame) -> DataFrame:
    """``lang, word`` forms made of the lexicon's words, right and wrong ones."""
    w = F.col("word")
    cut = F.substring(w, F.lit(1), F.length(w) - 1)
    forms = F.array(w, F.concat(w, F.lit("s")), F.concat(w, F.lit("ing")), F.concat(cut, F.lit("ies")), F.concat(cut, F.lit("ing")),
                    F.concat(F.lit("re"), w), F.concat(F.lit("re"), w, F.lit("s")), F.concat(F.lit("re"), w, F.lit("ing")),
                    F.concat(w, w), F.concat(w, w, w), F.concat(w, F.lit("q"), w))
    return lexicon.select("lang", F.explode(forms).alias("word")).distinct()


# --- F3: training-log lines from events ---------------------------------------
# FIXED VALUES: jobs that receive the validation (``error``) lines
VALID_JOBS = ("click", "purchase", "signup", "view")


def run_log(events: DataFrame) -> DataFrame:
    """``job, line_no, value`` log lines built from ``events``.

    Non-error events are train lines of job ``event_type``; error events are
    ``[valid]`` lines of one of the other jobs (``user_id % 4``); each job
    ends with a ``finished`` line. ``line_no`` = ``event_id`` (line order).
    """
    is_valid = F.col("event_type") == "error"
    job = F.when(is_valid, F.element_at(F.array(*[F.lit(j) for j in VALID_JOBS]),
                                        (F.col("user_id") % 4 + 1).cast("int"))).otherwise(F.col("event_type"))
    tsf = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    epoch = (F.floor(F.col("event_id") / 1000) + 1).cast("bigint")
    up = F.col("event_id") + 1
    sen = F.format_number((F.col("event_id") + 1) * 1000 + F.col("user_id"), 0)
    lr = F.lit(3e-4) * (F.col("user_id") % 5 + 1)
    train = F.format_string("[%s] Ep. %d : Up. %d : Sen. %s : Cost %.2f : Time %.2fs : %.2f words/s : L.r. %.4e",
                            tsf, epoch, up, sen, F.col("value"), F.col("value"), F.col("value") * 100, lr)
    stall = F.when(F.col("user_id") % 3 == 0, F.lit("new best")).otherwise(
        F.concat(F.lit("stalled "), (F.col("user_id") % 3).cast("string")))
    valid = F.format_string("[%s] [valid] Ep. %d : Up. %d : bleu-detok : %.2f : %s", tsf, epoch, up, F.col("value"), stall)
    lines = events.select(job.alias("job"), F.col("event_id").alias("line_no"),
                          F.when(is_valid, valid).otherwise(train).alias("value"))
    ends = (events.select(job.alias("job"), "event_id", "ts").groupBy("job")
            .agg((F.max("event_id") + 1).alias("line_no"), F.max("ts").alias("ts"))
            .select("job", "line_no", F.format_string("[%s] Training finished", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
                    .alias("value")))
    # a job starts with a devices line: as many GPUs as its name has letters
    starts = (events.select(job.alias("job"), "ts").groupBy("job").agg(F.min("ts").alias("ts"))
              .select("job", F.lit(-1).cast("bigint").alias("line_no"),
                      F.format_string("[%s] [config] --devices%s", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
                                      F.repeat(F.lit(" 0"), F.length("job"))).alias("value")))
    return lines.unionByName(ends).unionByName(starts)


def avg_log(events: DataFrame) -> DataFrame:
    """Averaged-model log lines ``x-y-<step> <score>`` (SRC12 input)."""
    return events.select(F.concat(F.lit("avg-"), (F.col("user_id") % 3).cast("string")).alias("name"),
                         F.col("event_id").alias("line_no"),
                         F.format_string("model-avg-%d %.2f", F.col("event_id") + 1, F.col("value")).alias("value"))


def experiments(events: DataFrame) -> DataFrame:
    """``session, split_n, metric, score, updated_at`` score records.

    One record per (session = event type, split = user_id % 10 + 1, week,
    metric); weekly re-scoring gives several updates per key. Scores are
    exact (integer-cent sums) so every engine computes the same values.
    """
    g = (events.groupBy(F.concat(F.lit("en-cy_"), F.col("event_type")).alias("session"),
                        (F.col("user_id") % 10 + 1).cast("int").alias("split_n"),
                        F.date_trunc("week", "ts").alias("week"))
         .agg((F.sum(F.round(F.col("value") * 100)) / F.count(F.lit(1)) / 100).alias("BLEU"),
              F.max("value").alias("CHRF"), F.min("value").alias("TER"),
              F.max("ts").alias("updated_at")))
    return g.select("session", "split_n", F.expr(
        "stack(3, 'BLEU', BLEU, 'CHRF', CHRF, 'TER', TER) AS (metric, score)"), "updated_at")


def session_records(events: DataFrame) -> DataFrame:
    """F8: session records; the event type gives the kind of record."""
    kind = F.create_map(*(F.lit(x) for kv in (("signup", "new"), ("click", "use"), ("purchase", "annotate"), ("view", "progress")) for x in kv))
    value = F.when(F.col("event_type") == "view", F.floor("value").cast("string")).otherwise(F.concat(F.lit("note "), F.col("event_id")))
    return events.where(F.col("event_type").isin("signup", "click", "purchase", "view")).select(
        F.concat(F.lit("en-cy_"), F.col("user_id") % 50).alias("session"), F.try_element_at(kind, "event_type").alias("kind"),
        value.alias("value"), F.col("ts").alias("at"), F.col("event_id").alias("seq"))


# --- written fixtures (F1 as files, F7) ------------------------------------------
def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``."""
    import uuid
    from corpusflow.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/fixtures/{tag}-{uuid.uuid4().hex}"


def _xml_escape(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def labelled(f1: DataFrame) -> DataFrame:
    """F1 with a space in one label, so that folder names need decoding."""
    return f1.withColumn("classifier", F.when(F.col("classifier") == "Health", F.lit("Public Health")).otherwise(F.col("classifier")))


def tmx_lines(f1: DataFrame) -> DataFrame:
    """F1 as TMX units, ``classifier, line_no, value``.

    The source language is written as ``XX-GB`` in two attributes; every third
    source carries level-2 markup; every fifth line is followed by a unit with
    an undeclared entity and one of a single side.
    """
    seg = F.when(F.col("line_no") % 3 == 0, F.concat(F.lit("{j}<ph>x</ph>"), _xml_escape(F.col("source")))).otherwise(_xml_escape(F.col("source")))
    tu = F.format_string('<tu><tuv lang="%s-GB" xml:lang="%s-GB"><seg>%s</seg></tuv><tuv xml:lang="%s"><seg>%s</seg></tuv></tu>',
                         F.upper("source_lang"), F.upper("source_lang"), seg, F.col("target_lang"), _xml_escape(F.col("target")))
    broken = F.lit('<tu><tuv xml:lang="en"><seg>a &nowhere; b</seg></tuv><tuv xml:lang="fr"><seg>c</seg></tuv></tu>'
                   '<tu><tuv xml:lang="en"><seg>alone</seg></tuv></tu>')
    value = F.when(F.col("line_no") % 5 == 0, F.concat(tu, broken)).otherwise(tu)
    return f1.select("classifier", "line_no", value.alias("value"))


def write_tmx_tree(f1: DataFrame, root: str) -> None:
    """F1 as TMX units under ``root/classifier=<label>/``."""
    tmx_lines(f1).drop("line_no").write.partitionBy("classifier").text(root)


#: units of a kind of packed file that share a number, on average at most
PACKED_UNITS = 32_000


def write_packed_tree(f1: DataFrame, root: str, files: int | None = None) -> None:
    """F1 as TMX units in ``files`` xz, gz and zip files each (as many as the units
    need, 4 at least), the zip files with a member for each label. A file has one
    writer, a line at a time."""
    files = files or max(4, -(-f1.count() // (3 * PACKED_UNITS)))
    kind = F.element_at(F.array(F.lit("xz"), F.lit("gz"), F.lit("zip")), F.col("line_no").cast("int") % 3 + 1)
    name = F.concat(kind, F.pmod(F.hash("value"), F.lit(files)))
    lines = tmx_lines(f1).select("classifier", "value", name.alias("file"))
    # a zip file has all labels, so the label is no key of it
    part = F.when(~F.col("file").startswith("zip"), F.col("classifier")).otherwise("")
    lines = lines.repartition("file", part).sortWithinPartitions("file", "classifier").select("file", "classifier", "value")

    def write(rows):
        import gzip
        import lzma
        import zipfile
        from functools import partial
        from itertools import groupby

        from corpusflow.sources.follow import _filesystem
        system, path = _filesystem(root)
        for name, own in groupby(rows, lambda r: r.file):
            members = groupby(own, lambda r: r.classifier)
            if name.startswith("zip"):
                system.create_dir(f"{path}/zipped", recursive=True)
                with system.open_output_stream(f"{path}/zipped/{name}.zip") as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
                    for label, lines_ in members:
                        with z.open(f"{label}/units.tmx", "w") as out:
                            out.writelines(r.value.encode() + b"\n" for r in lines_)
                continue
            for label, lines_ in members:
                system.create_dir(f"{path}/{label}", recursive=True)
                # quick rather than small: the files are read once
                packer = partial(lzma.open, preset=1) if name.startswith("xz") else partial(gzip.open, compresslevel=6)
                with system.open_output_stream(f"{path}/{label}/{name}.tmx.{name[:2]}", compression=None) as f, packer(f, "wb") as out:
                    out.writelines(r.value.encode() + b"\n" for r in lines_)

    lines.foreachPartition(write)


def _write_csv(df: DataFrame, root: str, **options) -> None:
    (df.write.mode("append").partitionBy("classifier").options(header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", **options)
     .csv(root))


def write_delimited_tree(f1: DataFrame, root: str, sep: str, extension: str = "csv") -> None:
    """F1 with quoted line ends in every fourth source, in files of two
    layouts: columns in either order, one with a column more."""
    f1 = f1.withColumn("source", F.when(F.col("line_no") % 4 == 0, F.concat(F.col("source"), F.lit("\nand more"))).otherwise(F.col("source")))
    options = dict(sep=sep, escape='"', quoteAll="true", extension=extension)
    _write_csv(f1.where("line_no % 2 = 0").select("classifier", "source", "target"), root, **options)
    _write_csv(f1.where("line_no % 2 = 1").select("classifier", F.col("line_no").alias("id"), "target", "source"), root, **options)


def write_wordfast_tree(f1: DataFrame, root: str) -> None:
    """F1 in the full Wordfast layout, with a ``&tA;`` tag in each source."""
    _write_csv(f1.select("classifier", F.lit("20200101~100000").alias("date"), F.lit("me").alias("user"), F.lit("0").alias("reuse"),
                         F.concat(F.upper("source_lang"), F.lit("-GB")).alias("src-lang"), F.concat("source", F.lit("&tA;")).alias("source"),
                         F.concat(F.col("target_lang"), F.lit("-GB")).alias("target-lang"), F.col("target"), F.lit("x").alias("attr1")),
               root, sep="\t", quote="")


def write_submissions(documents: DataFrame, root: str) -> None:
    """JSON records ``{submissions: [{id, domain}]}``, one per document."""
    (documents.select(F.array(F.struct(F.col("doc_id").alias("id"), F.col("source").alias("domain")))
                      .alias("submissions"))
     .write.json(root))


def write_log_chunks(run_log_df: DataFrame, root: str, chunk_days: int = 7) -> None:
    """F3 as rolled log files ``<job>/<time chunk>.../part-*``: one write.

    Lines are dealt by (job, time chunk), so a job's log is spread over tasks;
    the folder names sort in time order, as the lines do.
    """
    from corpusflow.operators.logs import wall_time
    week = F.date_format(F.from_unixtime(F.floor(F.unix_timestamp(wall_time(F.col("value"))) / (chunk_days * 86400)) * (chunk_days * 86400)), "yyyyMMdd")
    lines = run_log_df.withColumn("chunk", F.when(F.col("line_no") < 0, F.lit("00000000")).otherwise(week))
    (lines.repartition("job", "chunk").sortWithinPartitions("chunk", "job", "line_no").select("chunk", "job", "value")
     .write.partitionBy("chunk", "job").text(root))


def grow_logs(run_log_df: DataFrame, root: str, share: float = 1.0) -> None:
    """F3 as one log file ``<job>/train.log`` each, of which the first ``share``
    of a job's lines is there, and half of the line after them.

    One file has one writer: a job's lines pass through one task, a line at a
    time. What was there before stays as it is, so a reader sees the files grow.
    """
    from pyspark.sql import Window

    lines = run_log_df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("job")))
    lines = lines.repartition("job").sortWithinPartitions("job", "line_no").select("job", "value", "_n")

    def write(rows):
        from itertools import groupby

        from corpusflow.sources.follow import _filesystem
        system, path = _filesystem(root)
        for job, own in groupby(rows, lambda r: r.job):
            system.create_dir(f"{path}/{job}", recursive=True)
            with system.open_output_stream(f"{path}/{job}/train.log") as f:
                for i, r in enumerate(own):
                    text, whole = r.value.encode(), int(r["_n"] * share)
                    if i <= whole:
                        f.write(text + b"\n" if i < whole else text[:len(text) // 2])

    lines.foreachPartition(write)
