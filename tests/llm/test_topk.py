import math
import random

from corpusflow.llm import topk as K


def brute(rows, step, k=20):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, w in {i: v for i, v in ok if i % step == 0}.items():
        s = sorted((-sum(a * b for a, b in zip(w, v)), i) for i, v in ok if i != q)[:k]
        out += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s)]
    return sorted(out)


def run(spark, rows, k=20):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score long, rank int, lane int")
    w = K.weights(df)
    return sorted(tuple(r) for r in K.search(w.where("vec_id % 20 = 0"), w, k).collect())


def wide(rows):
    return [(i, v, None, None, None, None) for i, v in rows]


def test_against_brute_force_with_ties(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([0.0, 0.0, 0.25, -0.5, 1.0]) for _ in range(12)]) for i in range(300)]
    rows += [(300 + i, [0.0] * 11 + [0.125 * (i % 3)]) for i in range(100)]
    rows += [(500, None), (520, [1.0, None]), (540, [float("nan")] * 12), (560, [float("inf")] * 12), (580, []), (600, [1.0]),
             (None, [1.0] * 12), (620, [0.1] * 20), (640, [1e8] * 12)]
    assert run(spark, wide(rows)) == brute(rows, 20)


def test_fewer_candidates_than_k_and_empty(spark):
    rows = [(0, [1.0, 0.5]), (1, [0.5, 0.5]), (2, [0.5, 0.5])]
    assert run(spark, wide(rows)) == brute(rows, 20) and len(run(spark, wide(rows))) == 2
    assert run(spark, []) == []


def test_repeated_candidates_are_answered_each(spark):
    rows = [(0, [1.0]), (1, [0.5]), (1, [0.5])]
    assert [r[2] for r in run(spark, wide(rows))] == [1, 1]
