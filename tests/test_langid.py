"""The packed profile against the join, and what neither may get wrong."""

import random

from pyspark.sql import functions as F

from corpusflow.operators import langid as L

ALPHABETS = {"aa": "abcde ", "bb": "abcxy ", "cc": "ñéü😀漢 ", "dd": "zzzq"}


def texts(seed, n, most=60):
    rng = random.Random(seed)
    return [(i, lang, "".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randint(0, most))))
            for i, lang in ((i, rng.choice(sorted(ALPHABETS))) for i in range(n))]


def test_packed_is_the_join(spark, monkeypatch):
    profile = L.train_lang_profile(spark.createDataFrame(texts(1, 300), "i long, lang string, text string")).cache()
    rows = texts(2, 300) + [(900, "aa", None), (901, "aa", ""), (902, "aa", "é"), (903, "aa", "漢"), (904, "", "0987654321"),
                            (905, "aa", "ABCDE abcde " * 3000), (906, "bb", "İ ß")]
    df = spark.createDataFrame(rows, "i long, lang string, text string")
    packed, joined = L.detect_lang(df, profile), L.detect_lang(df, profile, packed_rows=1)
    assert "ArrowEvalPython" in packed._jdf.queryExecution().toString() and "ArrowEvalPython" not in joined._jdf.queryExecution().toString()
    want = sorted(map(str, joined.select(*df.columns, "detected").collect()))
    assert sorted(map(str, packed.collect())) == want
    monkeypatch.setattr(L, "CHARACTERS", 100)
    assert sorted(map(str, L.detect_lang(df, profile).collect())) == want
    found = {r.i: r.detected for r in packed.collect()}
    assert found[900] is found[901] is found[904] is None and found[905] == "aa"
    right = packed.where(F.length("text") > 20).agg(F.avg((F.col("lang") == F.col("detected")).cast("int"))).first()[0]
    assert right > 0.9


def test_no_shuffle_of_texts(spark):
    profile = L.train_lang_profile(spark.createDataFrame(texts(1, 50), "i long, lang string, text string"))
    plan = L.detect_lang(spark.range(10).select(F.lit("abc").alias("text")), profile)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_empty_profile(spark):
    none = L.train_lang_profile(spark.createDataFrame([], "lang string, text string"))
    assert L.detect_lang(spark.createDataFrame([("abc",)], "text string"), none).first().detected is None
