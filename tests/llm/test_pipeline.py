import random

import corpus_pipeline as P
from corpusflow.llm import decontaminate, neardup, quality, secrets
from tests.llm.data import ODD, documents, words
from tests.llm.test_neardup import brute

SF = "/root/testdata/sf0.001"


def test_stages_against_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    rows = []
    for name, stage in P.STAGES:
        path = __import__("corpusflow.llm.common", fromlist=["scratch"]).scratch(spark, "test-stage")
        stage(spark, kept, SF).write.parquet(path)
        before, kept = kept, spark.read.parquet(path)
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        rows.append(len(ids))
        if name == "quality":
            said = quality.classify(before, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()
            assert ids == {r.doc_id for r in said}
        elif name == "near_dedup":
            want = brute([(r.doc_id, r.text) for r in before.collect()], 5)
            assert ids == {d for d, v in want.items() if v[2]}
        elif name == "decontaminate":
            found = decontaminate.scan(before, spark.read.parquet(f"{SF}/benchmark.parquet")).withColumn("n_hit", decontaminate.n_hit())
            assert ids == {r.doc_id for r in found.where(~decontaminate.contaminated()).collect()}
        elif name == "secrets":
            assert all(r.n_chars == len(r.text) and not secrets.spans(r.text)[1] for r in kept.collect())
        if name != "mix":
            assert kept.schema.names == docs.schema.names
    assert rows[0] < 200 and rows[1] < rows[0] and rows[-1] == rows[-2] > 100
    out = P.run(spark, SF)
    assert sorted(map(str, out.collect())) == sorted(map(str, kept.collect()))
    assert out.select("position").distinct().count() == rows[-1]


def test_odd_rows_pass_every_stage(spark):
    rng = random.Random(1)
    rows = [*((i, " ".join(words(rng, 80))) for i in range(20)), *ODD]
    for clash in (True, False):
        docs = documents(spark, rows, clash)
        for name, stage in P.STAGES[1:]:
            out = stage(spark, docs, SF)
            assert out.count() == len(rows), name
            if name != "mix":
                assert out.columns == docs.columns
        assert P.STAGES[0][1](spark, docs, SF).columns == docs.columns
    for _, stage in P.STAGES:
        assert stage(spark, documents(spark, []), SF).count() == 0
