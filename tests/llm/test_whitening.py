import math

import numpy as np
import pytest

from corpusflow.llm import whitening as W


def brute(rows, scale=256, components=4):
    """By the dense covariance of the distinct vectors."""
    x = {}
    for i, (_, v) in enumerate(rows):
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            x[i] = [math.floor(scale * float(np.float32(c))) for c in v]
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    top = [i for i in range(len(sums))[::-1][:components] if values[i] > 1e-12 * values.sum()]
    out = {}
    for i, v in x.items():
        for k, j in enumerate(top, 1):
            out[i, k] = (n, sum((n * a - s) ** 2 for a, s in zip(v, sums)), float((np.array(v) - np.array(sums) / n) @ vectors[:, j] / np.sqrt(values[j])),
                         float(values[j] / values.sum()))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, None) for i, v in rows], "vec_id long, embedding array<float>, x long, n string")


def check(got, rows):
    want = brute(rows)
    found = {(r.vec_id, r.component): r for r in got.collect()}
    ids = {i: rows[i][0] for i, _ in want}
    assert set(found) == {(ids[i], k) for i, k in want}
    for k in {k for _, k in want}:
        a = np.array([found[ids[i], j].whitened for i, j in want if j == k])
        b = np.array([v[2] for (i, j), v in want.items() if j == k])
        assert np.abs(a - np.sign(a @ b) * b).max() < 1e-9
    for (i, k), (n, deviation, _, explained) in want.items():
        r = found[ids[i], k]
        assert (r.n, int(r.deviation)) == (n, deviation) and abs(r.explained - explained) < 1e-12 and r.identity_error < 1e-9


@pytest.mark.parametrize("dim, n", [(1, 30), (3, 200), (12, 90), (20, 9)])
def test_against_the_dense_covariance(spark, dim, n):
    rng = np.random.default_rng(dim)
    base = rng.normal(size=(n, dim)) @ rng.normal(size=(dim, dim)) + 5
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(n + i, v) for i, (_, v) in enumerate(rows[:7])]  # copies count once
    rows += [(1000, None), (1001, [None] + [0.0] * (dim - 1)), (1002, [float("nan")] * dim), (1003, [float("inf")] * dim)]
    check(W.whiten(frame(spark, rows).repartition(5)), rows)


def test_few_dimensions_and_odd_rows(spark):
    rows = [(i, [float(i % 3), 2.0 * (i % 3), 7.0, 0.0]) for i in range(30)]  # one dimension in four
    check(W.whiten(frame(spark, rows)), [*rows[:3], *rows[3:]])
    odd = [*rows, (None, [1.0, 2.0, 7.0, 0.0]), (3, [1.0, 2.0, 7.0, 0.0]), (90, [1.0]), (91, []), (92, [1e30, 0.0, 0.0, 0.0])]
    got = W.whiten(frame(spark, odd)).collect()
    assert len(got) == 32 and sum(r.vec_id is None for r in got) == 1 and sum(r.vec_id == 3 for r in got) == 2
    for none in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, [])], [(1, None)]):
        assert W.whiten(frame(spark, none)).collect() == []


def test_deviation_is_exact_beyond_long(spark):
    rows = [(i, [float(2 ** 36 * (i + 1)), float(-i)]) for i in range(40)]
    got = {r.vec_id: int(r.deviation) for r in W.whiten(frame(spark, rows)).collect()}
    assert got == {rows[i][0]: v[1] for (i, k), v in brute(rows).items()} and max(got.values()) > 2 ** 63


def test_rank_one_updates():
    """Values and vectors after each update, with equal values, zeros and tiny entries."""
    rng = np.random.default_rng(3)
    for trial in range(300):
        k = int(rng.integers(1, 12))
        values = np.sort(rng.choice([0.0, 1.0, 1.0 + 1e-14, 2.0, 1e-8, *rng.random(3) * 10], k))
        vectors = np.linalg.qr(rng.normal(size=(k, k)))[0]
        z = rng.normal(size=k) * rng.choice([0.0, 1e-12, 1e-5, 1.0, 30.0], k)
        rho = float(rng.choice([1e-3, 1.0, 50.0]))
        u = vectors @ z
        got, turned = W.rank_one(values, vectors, u, rho)
        want = (vectors * values) @ vectors.T + rho * np.outer(u, u)
        scale = max(np.abs(want).max(), 1e-300)
        assert np.abs((turned * got) @ turned.T - want).max() < 1e-13 * scale
        assert np.abs(turned.T @ turned - np.eye(k)).max() < 1e-13 and (np.diff(got) >= 0).all()


def test_many_updates_and_merges():
    rng = np.random.default_rng(5)
    x = rng.integers(-500, 500, (3000, 16)).astype(float) * np.arange(1, 17)
    parts = [W.Spectrum(16) for _ in range(4)]
    for i, v in enumerate(x):
        parts[i % 4].add(v)
    whole = W.Spectrum(16)
    for p in [W.Spectrum(16), *parts]:
        whole.merge(p)
    centred = x - x.mean(axis=0)
    want = centred.T @ centred
    assert whole.n == 3000 and np.abs(whole.mean - x.mean(axis=0)).max() < 1e-9
    assert np.abs((whole.vectors * whole.values) @ whole.vectors.T - want).max() < 1e-10 * np.abs(want).max()
