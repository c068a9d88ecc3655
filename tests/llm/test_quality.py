import random

import numpy as np
from corpusflow.llm import quality as Q
from tests.llm.data import ODD, documents, words

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = Q.op3_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in got)
    assert len(got) > 50 and right >= 0.95 * len(got)
    assert all(r.predicted == 1 for r in got if r.quality == 1)


def test_odd_rows_and_independence_of_other_columns(spark):
    rng = random.Random(8)
    good = [(i, " ".join(words(rng, 60)).capitalize() + ".") for i in range(60)]
    bad = [(100 + i, "!! ".join(w.upper() for w in words(rng, 60))) for i in range(60)]
    labels = spark.createDataFrame([*((i, 1, 0) for i, _ in good), *((i, 0, 0) for i, _ in bad), (1, None, 0), (2, 7, 0), (None, 1, 0), (9999, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = [*good, *bad, *ODD]
    got = Q.classify(documents(spark, rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by = {r.doc_id: r for r in got}
    assert np.mean([by[i].predicted for i, _ in good]) > 0.9 and np.mean([by[i].predicted for i, _ in bad]) < 0.1
    again = {r.doc_id: r.score for r in Q.classify(documents(spark, rows[::-1], clash=False).repartition(5), labels.repartition(3)).collect()}
    assert again == {d: r.score for d, r in by.items()}


def test_no_labels_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in Q.classify(documents(spark, ODD), none).collect()} == {0.5}
    assert Q.classify(documents(spark, []), none).count() == 0
    assert Q.accepted(documents(spark, ODD), none).count() == len(ODD)


def test_isotonic():
    at, value = Q.isotonic(np.array([0., 1, 2, 3]), np.array([1., 1, 1, 1]), np.array([0., 1, 0, 1]))
    assert value.tolist() == [0, 0.5, 1] and at.tolist() == [0, 1.5, 3]
