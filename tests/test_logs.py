"""Log parsing and run statistics on hand-written lines."""

import pytest

from corpusflow.operators import logs as L

LINES = [
    ("j", 1, "[2024-01-01 00:00:00] [marian] --devices 0 1 2 3 --foo"),
    ("j", 2, "[2024-01-01 00:00:10] Ep. 1 : Up. 1000 : Sen. 1,234,567 : Cost 7.12 : Time 30.20s : 1000.00 words/s : L.r. 1.8750e-05"),
    ("j", 3, "[2024-01-01 00:00:20] [valid] Ep. 1 : Up. 1000 : bleu-detok : 23.4 : new best"),
    ("j", 4, "[2024-01-01 00:00:30] [valid] Ep. 1 : Up. 1000 : ce-mean-words : 2.5 : stalled 3"),
    ("j", 5, "[2024-01-02 02:00:30] Ep. 2 : Up. 2000 : Sen. 9 : Cost 6.00 : Time 10.00s : 900.00 words/s : L.r. 3.0000e-04"),
    ("j", 6, "[2024-01-02 03:00:00] Training finished"),
    ("k", 1, "[2024-01-01 00:00:00] Ep. 1 : Up. 10 : Sen. 100 : Cost 1.00 : Time 1.00s : 1.00 words/s"),
]


@pytest.fixture()
def lines(spark):
    return spark.createDataFrame(LINES, "job string, line_no long, value string")


def test_parse_train_full_numbers(lines):
    rows = {r["up"]: r for r in L.parse_train(lines).collect()}
    assert rows[1000]["sen"] == 1234567
    assert rows[1000]["lr"] == pytest.approx(1.875e-05)
    assert rows[10]["lr"] is None


def test_parse_valid_keeps_new_best(lines):
    rows = {r["metric"]: r for r in L.parse_valid(lines).collect()}
    assert rows["bleu-detok"]["stalled"] == 0 and rows["bleu-detok"]["value"] == pytest.approx(23.4)
    assert rows["ce-mean-words"]["stalled"] == 3


def test_gpu_count(lines):
    assert [r["gpus"] for r in L.gpu_count(lines).collect()] == [4]


def test_duration_over_a_day_and_missing_finish(lines):
    d = {r["job"]: r["hours"] for r in L.duration_hours(lines).collect()}
    assert d["j"] == pytest.approx(27.0)
    assert d["k"] == -1.0


def test_sentences_diff_and_pause(spark, lines):
    train = L.parse_train(lines)
    diffs = {r["up"]: r["sen_diff"] for r in L.sentences_diff(train).collect()}
    assert diffs[1000] == 1234567 and diffs[2000] == 9 - 1234567
    adj = {r["line_no"]: r for r in L.pause_adjusted(train.select("job", "line_no", "ts")).where("job = 'j'").collect()}
    # one short gap before the pause? none: first train line has no gap; the pause is
    # taken out entirely (mean of short gaps = 0)
    assert adj[5]["gap"] > 1200
    assert adj[5]["adj_ts"] == pytest.approx(adj[2]["ts"].timestamp())


def test_clock_does_not_depend_on_chunks_or_batches(spark):
    import random
    from pyspark.sql import functions as F
    rng = random.Random(4)
    rows, t = [], 0
    for i in range(400):
        t += rng.choice([1, 5, 60, 1200, 1201, 5000])
        kind = rng.choice(["train", "train", "valid", "devices", "other"])
        rows.append((rng.choice("ab"), i, t, kind, i * 10 if kind == "train" else None, i % 5 if kind == "devices" else None))
    df = spark.createDataFrame(rows, "job string, line_no long, t long, kind string, sen long, gpus int").withColumn("ts", F.timestamp_seconds("t"))
    names = ["job", "line_no", "gap", "adj_ts", "burst", "sen_diff", "gpus_now"]
    want = sorted(map(str, L.clock(df).select(*names).collect()))
    for size in (1, 7, 50):
        assert sorted(map(str, L.clock(df, chunk=F.floor(F.col("line_no") / size)).select(*names).collect())) == want
    got, carry = [], None
    for lo, hi in ((0, 3), (3, 90), (90, 91), (91, 400)):
        part = L.clock(df.where(f"line_no >= {lo} and line_no < {hi}"), carry=carry)
        got += map(str, part.select(*names).collect())
        carry = spark.createDataFrame(L.carry_of(part, carry).collect(), L.STATE)
    assert sorted(got) == want


def test_avg_logs(spark):
    df = spark.createDataFrame([("avg-8", 1, "x-y-100 23.5"), ("avg-8", 2, "bad 1"), ("avg-8", 3, "x-y-200")],
                               "name string, line_no long, value string")
    assert [(r["step"], r["score"]) for r in L.parse_avg_logs(df).collect()] == [(100, 23.5)]
