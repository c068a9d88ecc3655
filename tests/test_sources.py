"""Sources and sinks on small written files (under spark.checkpoint.dir)."""

import os

from pyspark.sql import functions as F

from corpusflow.operators import logs as L
from corpusflow.operators import pairs
from corpusflow.plans.fixtures import scratch_dir
from corpusflow.sources import bitext, logs as logsrc, sinks


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_tmx_level2_and_codes(spark):
    root = scratch_dir(spark, "t-tmx")
    _write(f"{root}/Health", "a.tmx", """<?xml version="1.0"?><tmx><body>
<tu><tuv xml:lang="en-GB"><seg>Hello {b}<bpt i="1">x</bpt>world{/b}</seg></tuv><tuv xml:lang="CY"><seg>Helo</seg></tuv></tu>
<tu><tuv xml:lang="en-GB"><seg>a {j}<ph>z</ph>b</seg></tuv><tuv xml:lang="cy"><seg>c</seg></tuv></tu>
<tu><tuv xml:lang="en"><seg>only one side</seg></tuv></tu>
</body></tmx>""")
    rows = bitext.with_label(bitext.read_tmx(spark, root)).orderBy("source").collect()
    assert [(r["source_lang"], r["source"], r["target_lang"], r["target"], r["classifier"]) for r in rows] == [
        ("en", "Hello {b}world{/b}", "cy", "Helo", "Health"),
        ("en", "a {j} b", "cy", "c", "Health")]


def test_wordfast_and_dispatch(spark):
    root = scratch_dir(spark, "t-wf")
    _write(f"{root}/Unknown", "m.txt", "src-lang\tsource\ttarget-lang\ttarget\nEN-GB\tHi &tA;there\tCY-GB\tHelo\n")
    _write(f"{root}/Unknown", "p.csv", "source,target\n\"a, b\",c\n")
    units = bitext.read_tree(spark, root, ("en", "cy")).orderBy("source").collect()
    assert [(u["source_lang"], u["source"], u["target"], u["classifier"]) for u in units] == [
        ("en", "Hi there", "Helo", "Unknown"), ("en", "a, b", "c", "Unknown")]


def test_tmx_of_real_files(spark):
    root = scratch_dir(spark, "t-tmx2")
    _write(f"{root}/Public Health+", "a b.tmx", """<?xml version="1.0"?><tmx><body>
<tu><tuv lang="en-GB" xml:lang="en"><seg>One &amp; two</seg></tuv><tuv lang="cy-GB" xml:lang="cy"><seg>Un</seg></tuv></tu>
<tu><tuv xml:lang="en"><seg>bad &nowhere; text</seg></tuv><tuv xml:lang="cy"><seg>x</seg></tuv></tu>
<tu><tuv xml:lang="en"><seg>torn <b>text</seg></tuv><tuv xml:lang="cy"><seg>x</seg></tuv></tu>
<tu><tuv><seg>no language</seg></tuv><tuv xml:lang="cy"><seg>x</seg></tuv></tu>
<tu><prop type="x">note</prop><tuv xml:lang="EN"><note>n</note><seg>Three</seg></tuv><tuv xml:lang="cy"><seg>Tri</seg></tuv></tu>
</body></tmx>""")
    rows = bitext.with_label(bitext.read_tmx(spark, root)).orderBy("source").collect()
    assert [(r["source_lang"], r["source"], r["target_lang"], r["target"], r["classifier"]) for r in rows] == [
        ("en", "One & two", "cy", "Un", "Public Health+"), ("en", "Three", "cy", "Tri", "Public Health+")]
    reasons = {r["reject_reason"]: r["n"] for r in bitext.tmx_units(spark, root).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert reasons == {None: 2, "malformed": 2, "one_sided": 1}


def test_csv_by_header_name(spark):
    root = scratch_dir(spark, "t-csv")
    _write(root, "a.csv", 'target,source\nt1,s1\n"t\n2","s ""2"" x"\n')
    _write(root, "b.csv", "id, Source ,target,note\n1,s3,t3,n\n")
    got = sorted((r["source"], r["target"]) for r in bitext.read_csv_bitext(spark, root, ("en", "cy")).collect())
    assert got == [('s "2" x', "t\n2"), ("s1", "t1"), ("s3", "t3")]
    _write(root, "c.csv", "left,right\na,b\n")
    import pytest
    with pytest.raises(ValueError):
        bitext.read_csv_bitext(spark, root, ("en", "cy"))
    assert bitext.read_csv_bitext(spark, root, ("en", "cy"), glob="*.none").count() == 0


def test_tsv_in_utf16(spark):
    root = scratch_dir(spark, "t-tsv")
    os.makedirs(root)
    with open(f"{root}/a.tsv", "w", encoding="utf-16") as f:
        f.write("source\ttarget\nŵyn\tlamb\n")
    got = [(r["source"], r["target"]) for r in bitext.read_tsv_bitext(spark, root, ("cy", "en"), encoding="UTF-16").collect()]
    assert got == [("ŵyn", "lamb")]


def test_full_wordfast_layout(spark):
    root = scratch_dir(spark, "t-wf2")
    _write(root, "named.txt", "date\tuser\treuse\tsrc-lang\tsource\ttarget-lang\ttarget\tattr1\n"
                              "20200101~1\tme\t0\tEN-GB\tHi &tB;you\tCY-GB\tHelo\tx\n20200101~1\tme\t0\t\tno\tCY\tna\tx\n")
    _write(root, "plain.txt", "%20200101~1\t%user\t%TU=1\t%EN-GB\t%Wordfast TM v.5\t%CY-GB\t%-----------\t.\n"
                              "20200101~1\tme\t0\tEN-GB\tA \"quoted\tCY-GB\tb\tx\n")
    rows = sorted((r["source_lang"], r["source"], r["target_lang"], r["target"]) for r in bitext.read_wordfast(spark, root).collect())
    assert rows == [("en", 'A "quoted', "cy", "b"), ("en", "Hi you", "cy", "Helo")]


def test_aligned_lines_and_triples(spark):
    root = scratch_dir(spark, "t-al")
    _write(root, "src.txt", "s1\ns2\ns1\n")
    _write(root, "ref.txt", "r1\nr2\nr3\n")
    _write(root, "hyp.txt", "h1\nh2\nh3\n")
    s, r, h = bitext.read_aligned(spark, f"{root}/src.txt", f"{root}/ref.txt", f"{root}/hyp.txt")
    out = sorted((x["line_no"], x["src"], x["ref"], x["hyp"]) for x in pairs.join_triples(s, r, h).collect())
    assert out == [(2, "s2", "r2", "h2"), (3, "s1", "r3", "h3")]  # repeated source keeps its last line


def test_log_files_and_gpus(spark):
    root = scratch_dir(spark, "t-log")
    _write(f"{root}/job1", "marian.log",
           "[2024-01-01 00:00:00] --devices 0 1\n"
           "[2024-01-01 00:00:10] Ep. 1 : Up. 1 : Sen. 10 : Cost 1.00 : Time 1.00s : 1.00 words/s\n"
           "[2024-01-01 00:00:20] Ep. 1 : Up. 2 : Sen. 20 : Cost 1.00 : Time 1.00s : 1.00 words/s\n")
    lines = logsrc.read_logs(spark, root)
    train = L.parse_train(lines)
    got = sorted((r["up"], r["gpus"], r["job"]) for r in L.with_gpus(lines, train).collect())
    assert got == [(1, 2, "job1"), (2, 2, "job1")]


def test_corpus_roundtrip_and_inventory(spark):
    root = scratch_dir(spark, "t-corpus")
    df = spark.createDataFrame([(1, "Health", "a", "b", "en-cy"), (1, "Health", "a", "b", "en-cy"),
                                (2, "Unknown", "c", "d", "en-cy")],
                               "id long, classifier string, source string, target string, langs string")
    sinks.write_cleaned(df, f"{root}/clean")
    assert bitext.load_corpus(spark, f"{root}/clean").count() == 2
    sp = df.withColumn("split_n", F.lit(1)).withColumn("label", F.lit("train"))
    sinks.write_splits(sp, f"{root}/splits")
    inv = [(r["split_n"], r["label"]) for r in sinks.split_inventory(spark, f"{root}/splits").collect()]
    assert inv == [(1, "train")]


def test_headerless_files_are_one_scan(spark):
    root = scratch_dir(spark, "t-wf3")
    for i in range(6):
        _write(root, f"m{i}.txt", f"2020010{i}~1\tme\t0\tEN-GB\ttext {i}\tCY-GB\ttestun {i}\tx\n")
    df = bitext.read_wordfast(spark, root)
    assert sorted(r["source"] for r in df.collect()) == [f"text {i}" for i in range(6)]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_tmx_unit_is_read_once(spark):
    units = {
        '<tu><tuv lang="EN-gb" xml:lang="fr"><seg>a{j}<ph>x<b>y</b></ph>b<!-- c -->c<?pi?>d&lt;&#65;</seg><seg>2</seg></tuv>'
        '<tuv xml:lang="cy"><note/><seg> e <i>f</i>\r\ng</seg></tuv></tu>': ("en", "a{j} b c d<A", "cy", " e f\ng", None),
        '<tu><tuv z:lang="fr" b:lang="de"><seg>{<b>x</b>}</seg></tuv><p:tuv lang="c&#121;"><p:seg>t</p:seg></p:tuv></tu>': ("de", "{}", "cy", "t", None),
        '<tu><tuv lang="en"><seg>}<![CDATA[<]]>u</seg></tuv><tuv lang="cy"><seg><![CDATA[<]]>u</seg></tuv></tu>': ("en", "}", "cy", "<u", None),
        '<tu><tuv lang="en"><x><seg>a</seg></x></tuv><tuv lang="en"><seg>b</seg></tuv></tu>': ("en", "b", None, "", "one_sided"),
        '<tu><tuv lang="en"><seg>a</tuv></tu>': (None, None, None, None, "malformed"),
    }
    records = spark.createDataFrame([(u.removesuffix("</tu>"), u) for u in units], "value string, source_path string")
    df = bitext._units_of(records)
    got = {r.source_path: (r.source_lang, r.source, r.target_lang, r.target, r.reject_reason) for r in df.collect()}
    assert got == units
    kept = df.where("reject_reason is null")
    assert "xpath" not in kept._jdf.queryExecution().executedPlan().toString()
