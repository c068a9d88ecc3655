"""Bitext sources (SRC1-SRC9): translation memories and line files as units.

Every reader returns raw units ``source_lang, source, target_lang, target,
source_path`` (languages already canonical, TXT6) for the cleaning step.
Readers split large inputs across tasks: TMX is read as text records cut at
``</tu>``, not as whole files.
"""

from __future__ import annotations

import csv
from functools import reduce
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusflow.functions.text import lang_code, strip_wf_tags

UNIT_COLUMNS = ["source_lang", "source", "target_lang", "target", "source_path"]

# --- FIXED VALUES: TMX structure ------------------------------------------------
TU_END = "</tu>"
TU_START = r"(?s)(<tu[\s>].*)$"
#: columns of a Wordfast memory whose file has no header with their names
WORDFAST_COLUMNS = ("date", "user", "reuse", "src-lang", "source", "target-lang", "target",
                    "attr1", "attr2", "attr3", "attr4")


def _file_path() -> F.Column:
    """The file's path as it is named in the store, not percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


class _Sides:
    """Handlers that read one ``tu``: of each ``tuv`` with a ``seg``, in ``found``,
    its first attribute of the local name ``lang`` (by name, empty if none) and
    the text of its first ``seg``.

    Only for level-2 markup (a segment with ``{`` or ``}``) the segment's own
    text nodes are kept, joined by a space if ``{j`` occurs. Of a text node with a
    CDATA section that is its first piece.
    """

    def __init__(self):
        self.path, self.found, self.lang, self.segs = [], [], "", 0
        self.all, self.nodes, self.inside, self.closed = [], [], False, False

    def start(self, name, attributes):
        self.inside = False
        self.path.append(name.rpartition(":")[2])
        if self.path == ["tu", "tuv"]:
            langs = [kv for kv in zip(attributes[::2], attributes[1::2]) if kv[0].rpartition(":")[2] == "lang" and not kv[0].startswith("xmlns:")]
            self.lang, self.segs, self.all, self.nodes = min(langs)[1] if langs else "", 0, [], []
        elif self.path == ["tu", "tuv", "seg"]:
            self.segs += 1

    def end(self, name):
        self.inside = False
        if self.path == ["tu", "tuv"] and self.segs:
            text = "".join(self.all)
            if "{" in text or "}" in text:
                text = (" " if "{j" in text else "").join(self.nodes)
            self.found.append((self.lang, text))
        self.path.pop()

    def other(self, *_):
        self.inside = False

    def cdata(self):
        # a section goes on the node before it, or begins one
        if self.inside:
            self.closed = True
        else:
            self.text("")

    def cdata_end(self):
        self.closed = True

    def text(self, data):
        if self.segs == 1 and self.path[:3] == ["tu", "tuv", "seg"]:
            self.all.append(data)
            if len(self.path) == 3:
                if not self.inside:
                    self.nodes.append(data)
                elif not self.closed:
                    self.nodes[-1] += data
                if not self.inside:
                    self.inside, self.closed = True, False


def _sides_of(unit: str) -> list[tuple[str, str]] | None:
    """(language, text) of each side of a ``tu``; None if it is no XML."""
    sides, parser = _Sides(), expat.ParserCreate()
    parser.ordered_attributes = parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = sides.start, sides.end, sides.text
    parser.StartCdataSectionHandler, parser.EndCdataSectionHandler = sides.cdata, sides.cdata_end
    parser.CommentHandler = parser.ProcessingInstructionHandler = sides.other
    try:
        parser.Parse(unit, True)
    except expat.ExpatError:
        return None
    return sides.found


def _parsed(batches):
    """Batches ``_bad, _x, ...`` with the two sides of ``_x`` in place of it."""
    for b in batches:
        bad, out = [], []
        for broken, unit in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            found = None if broken or unit is None else _sides_of(unit)
            bad.append(found is None)
            if found is None:
                out.append((None,) * 5)
            else:
                (s, source), (t, target) = (*found[:2], ("", ""), ("", ""))[:2]
                out.append((len(found) > 1, s, source, t, target))
        two, *texts = zip(*out) if out else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(bad, pa.bool_()), pa.array(two, pa.bool_()), *(pa.array(x, pa.string()) for x in texts), *b.columns[2:]],
                                         names=["_bad", "_two", "_s", "source", "_t", "target", *b.schema.names[2:]])


def tmx_units(spark: SparkSession, path: str, glob: str | None = "*.tmx") -> DataFrame:
    """Every ``tu`` of the TMX files, with ``reject_reason``: null, ``malformed``
    (no XML by itself, e.g. an entity that is declared nowhere) or
    ``one_sided`` (not two sides with a language each)."""
    reader = spark.read.option("lineSep", TU_END).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _units_of(reader.text(path).select("value", _file_path().alias("source_path")))


def packed_tmx_units(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`tmx_units`, of the TMX files inside xz, gz and zip files; what
    cannot be unpacked is a row with the reason ``damaged``."""
    from corpusflow.sources.packed import read_packed
    found = read_packed(spark, path, sep=TU_END)
    units = _units_of(found.select("value", "source_path", "error"), "error")
    return units.withColumn("reject_reason", F.when(F.col("error").isNotNull(), F.lit("damaged")).otherwise(F.col("reject_reason"))).drop("error")


def read_packed_tmx(spark: SparkSession, path: str) -> DataFrame:
    """SRC13: units of packed TMX files; :func:`packed_tmx_units` says what is left out."""
    return packed_tmx_units(spark, path).where(F.col("reject_reason").isNull()).drop("reject_reason")


def _units_of(records: DataFrame, *more: str) -> DataFrame:
    """Units of ``value, source_path``, each a text up to the end of a ``tu``."""
    keep = F.col("_x") != ""
    for c in more:
        keep = keep | F.col(c).isNotNull()
    recs = (records.select(F.regexp_extract("value", TU_START, 1).alias("_x"), "source_path", *more).where(keep)
            .withColumn("_x", F.concat(F.col("_x"), F.lit(TU_END))))
    parsed = F.from_xml("_x", "_broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    recs = recs.select((parsed["_broken"].isNotNull() | F.col("_x").rlike(UNDECLARED)).alias("_bad"), "_x", "source_path", *more)
    # a unit is read once for all its fields
    units = recs.mapInArrow(_parsed, ", ".join(["_bad boolean, _two boolean, _s string, source string, _t string, target string", *(f"{c} string" for c in ("source_path", *more))]))
    lang = lambda c: F.nullif(lang_code(F.col(c)), F.lit(""))
    units = units.select("_bad", "_two", lang("_s").alias("source_lang"), "source", lang("_t").alias("target_lang"), "target", "source_path", *more)
    sided = F.col("_two") & F.col("source_lang").isNotNull() & F.col("target_lang").isNotNull()
    return units.withColumn("reject_reason", F.when(F.col("_bad"), F.lit("malformed")).when(~F.coalesce(sided, F.lit(False)), F.lit("one_sided"))
                            ).drop("_bad", "_two")


#: an entity reference that XML itself does not declare
UNDECLARED = r"&(?!(?:amp|lt|gt|quot|apos);|#[0-9]+;|#x[0-9A-Fa-f]+;)"


def read_tmx(spark: SparkSession, path: str, glob: str | None = "*.tmx") -> DataFrame:
    """SRC1/SRC2: TMX units; language = the tuv's lang attribute, region cut.

    A unit lacking either side is dropped, as in the reference; so is one that
    is not well-formed, instead of failing the job (see :func:`tmx_units`).
    """
    return tmx_units(spark, path, glob).where(F.col("reject_reason").isNull()).drop("reject_reason")


def _headers(spark: SparkSession, path: str, encoding: str, glob: str | None) -> list[tuple[str, list[str]]]:
    """(first line, files that start with it): as many as there are layouts.

    The first line of each file is found in parallel; the driver gets the file
    names, which Spark's own file index holds as well.
    """
    reader = (spark.read.option("sep", "\u0001").option("quote", "").option("encoding", encoding)
              .option("multiLine", str(encoding.upper() not in ("UTF-8", "UTF8")).lower()).option("recursiveFileLookup", "true"))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.schema("line string").csv(path).select(
        "line", F.col("_metadata.file_block_start").alias("b"), _file_path().alias("f"), F.monotonically_increasing_id().alias("i"))
    firsts = lines.where("b = 0").groupBy("f").agg(F.min_by("line", "i").alias("line"))
    groups = firsts.groupBy("line").agg(F.array_sort(F.collect_list("f")).alias("files")).orderBy("line")
    return [(r["line"].lstrip("\ufeff"), r["files"]) for r in groups.collect()]


def _read_by_name(spark: SparkSession, path: str, wanted, sep: str, encoding: str, glob: str | None, multi_line: bool,
                  quote: str = '"', without_header=None) -> DataFrame:
    """Columns ``wanted`` by header name from files whose headers may differ.

    Names match without regard to case and spaces around them. A file whose
    first line lacks one of them is read by the columns ``without_header`` if
    given (the first line is then data), else it is an error. Files of one
    layout are read together.
    """
    parts, layouts = [], {}
    for line, files in _headers(spark, path, encoding, glob):
        names = [c.strip().lower() for c in next(csv.reader([line], delimiter=sep, quotechar=quote or None,
                                                            quoting=csv.QUOTE_MINIMAL if quote else csv.QUOTE_NONE), [])]
        named = all(w in names for w in wanted)
        if not named and without_header is None:
            raise ValueError(f"no column {', '.join(w for w in wanted if w not in names)} in the header of {files[0]}")
        layouts.setdefault((named, tuple(names if named else without_header)), []).extend(files)
    for (named, columns), files in sorted(layouts.items()):
        schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(columns))])
        df = (spark.read.option("header", str(named).lower()).option("enforceSchema", "true").option("sep", sep)
              .option("encoding", encoding).option("quote", quote).option("escape", quote or "\\")
              .option("multiLine", str(multi_line).lower())
              .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
              .schema(schema).csv(files))
        parts.append(df.select(*(F.col(f"c{columns.index(w)}").alias(w) for w in wanted), _file_path().alias("source_path")))
    if not parts:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in (*wanted, "source_path")]))
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_csv_bitext(spark: SparkSession, path: str, langs, fieldnames=("source", "target"),
                    sep: str = ",", encoding: str = "UTF-8", glob: str | None = "*.csv",
                    multi_line: bool = True) -> DataFrame:
    """SRC3/SRC4: CSV or TSV with a header; columns by name, languages by ``fieldnames``.

    Files may order their columns differently and have others. Quoted line
    ends are read right, for which a file is one task; ``multi_line=False``
    splits files, for inputs of one record per line.
    """
    s, t = fieldnames
    df = _read_by_name(spark, path, (s.lower(), t.lower()), sep, encoding, glob, multi_line)
    return df.select(F.lit(langs[0]).alias("source_lang"), F.col(s.lower()).alias("source"),
                     F.lit(langs[1]).alias("target_lang"), F.col(t.lower()).alias("target"), "source_path")


def read_tsv_bitext(spark: SparkSession, path: str, langs, encoding: str = "UTF-8",
                    glob: str | None = "*.tsv") -> DataFrame:
    """SRC4: tab-separated bitext; the encoding is a parameter (not sniffed)."""
    return read_csv_bitext(spark, path, langs, sep="\t", encoding=encoding, glob=glob)


def read_wordfast(spark: SparkSession, path: str, glob: str | None = "*.txt", encoding: str = "UTF-8") -> DataFrame:
    """SRC5: Wordfast TM text: languages from its columns, ``&tX;`` tags removed.

    Columns by the header's names; a file whose first line does not name them
    has the full Wordfast layout, and its own header line (``%...``) has no
    languages. Rows without both languages are dropped.
    """
    df = _read_by_name(spark, path, ("src-lang", "source", "target-lang", "target"), "\t", encoding, glob,
                       multi_line=encoding.upper() not in ("UTF-8", "UTF8"), quote="", without_header=WORDFAST_COLUMNS)
    lang = lambda c: F.when(~F.col(c).startswith("%"), F.nullif(lang_code(F.col(c)), F.lit("")))
    return (df.select(lang("src-lang").alias("source_lang"), strip_wf_tags(F.col("source")).alias("source"),
                      lang("target-lang").alias("target_lang"), strip_wf_tags(F.col("target")).alias("target"), "source_path")
            .where(F.col("source_lang").isNotNull() & F.col("target_lang").isNotNull()))


def read_bitext(spark: SparkSession, path: str, langs, tsv_encoding: str = "UTF-8") -> DataFrame:
    """SRC6: every supported file under ``path``, format chosen by extension."""
    parts = [read_tmx(spark, path), read_csv_bitext(spark, path, langs),
             read_tsv_bitext(spark, path, langs, tsv_encoding), read_wordfast(spark, path)]
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_label(units: DataFrame) -> DataFrame:
    """SRC7: label = name of the file's parent directory (for a partition
    folder ``key=value``, its value)."""
    return units.withColumn("classifier", F.regexp_extract("source_path", r"([^/=]+)/[^/]+$", 1))


def read_tree(spark: SparkSession, root: str, langs) -> DataFrame:
    """SRC7: all inputs under ``root``, one label per parent directory."""
    return with_label(read_bitext(spark, root, langs))


def load_corpus(spark: SparkSession, path: str) -> DataFrame:
    """SRC8: every cleaned file (Parquet dataset) then DED2."""
    from corpusflow.operators.pairs import dedup_pairs
    df = spark.read.parquet(path)
    return dedup_pairs(df.select("id", "classifier", "source", "target", "langs"))


def number_lines(raw: DataFrame) -> DataFrame:
    """``value, file, line_no`` of a text scan: the exact 1-based line number in each file.

    Computed in parallel with no Python and no global sort: the position of a
    line inside its file split (a window per split, in scan order) plus the
    number of lines in the earlier splits of the same file (a prefix over a
    per-split count table).
    """
    raw = raw.select("value", _file_path().alias("file"), F.col("_metadata.file_block_start").alias("_b"),
                     F.monotonically_increasing_id().alias("_m"))
    local = raw.withColumn("_pos", F.row_number().over(Window.partitionBy("file", "_b").orderBy("_m")))
    sizes = raw.groupBy("file", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("file", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return local.join(offsets, ["file", "_b"]).select("value", "file", (F.col("_pos") + F.col("_off")).cast("bigint").alias("line_no"))


def read_aligned(spark: SparkSession, *paths: str):
    """SRC9: line files read back as ``(line_no, text)`` tables, one per path.

    Line files of any size then pair up by an equi-join on ``line_no``.
    """
    out = [number_lines(spark.read.text(p)).select("line_no", F.col("value").alias("text")) for p in paths]
    return out if len(out) > 1 else out[0]
