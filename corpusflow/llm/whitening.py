"""Embedding whitening by incremental eigendecomposition (operator 11).

A spectrum is the number of vectors, their mean, and the eigenvalues and
eigenvectors of their scatter (the sum of centred outer products). A partition
starts with none and takes one vector at a time: the scatter grows by a
centred rank-one term, whose new eigenvalues are the roots of a secular
equation, found in all gaps at once, after entries that change nothing and
equal eigenvalues have been deflated. Two spectra are combined by one rank-one
update for each eigenpair of the second and one for the distance of the means,
in a tree of tasks. The result's vectors are the basis of a last pass over the
data, in which partitions sum the covariance in that basis; its small
eigenproblem (Rayleigh-Ritz) takes out the rounding of all updates before.

A partition's work for each vector is that of one product of square matrices
of the dimension; what travels is a square matrix for each partition, and the
driver holds a few of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import column, read, slices, written
from corpusflow.llm.topk import _usable

#: spectra that one task combines
FAN = 8
#: vectors that one partition takes, and partitions at most
TAKEN, PARTITIONS = 4096, 10_000
#: rows that are turned into an array at a time
ROWS = 1024
#: an eigenvalue below this share of their sum counts as zero
NONE = 1e-12
#: steps that a root takes at most; the bracket is halved where a step leaves it
STEPS = 80
EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + rho * sum(z2 / (d - x))`` for strictly rising ``d``: the
    place of the pole next to each root, and the root's distance from it."""
    k = len(d)
    gap = np.append(d[1:] - d[:-1], rho * z2.sum())
    weight = rho * z2
    # the nearer pole is the left one where the function is positive half way
    half = d[None, :] - d[:, None] - gap[:, None] / 2
    right = (1 + (weight / half).sum(axis=1) < 0) & (np.arange(k) < k - 1)
    pole = np.arange(k) + right
    delta = d[None, :] - d[pole][:, None]
    lo, hi = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, gap / 2)
    hi[-1] = gap[-1]
    left = np.arange(k)[None, :] <= np.arange(k)[:, None]
    x = (lo + hi) / 2
    near, far = np.arange(k), np.minimum(np.arange(k) + 1, k - 1)
    d_near, d_far = delta[np.arange(k), near], delta[np.arange(k), far]
    live = np.arange(k)
    for _ in range(STEPS):
        away = delta[live] - x[live, None]
        w = weight / away
        below = np.where(left[live], w, 0.0)
        psi, phi = below.sum(axis=1), (w - below).sum(axis=1)
        f = 1 + psi + phi
        hi[live], lo[live] = np.where(f > 0, x[live], hi[live]), np.where(f > 0, lo[live], x[live])
        noise = EPS * (1 + np.abs(w).sum(axis=1))
        done = (np.abs(f) <= noise) | (hi[live] - lo[live] <= EPS * np.maximum(np.abs(lo[live]), np.abs(hi[live])))
        slope = w / away
        d_psi = np.where(left[live], slope, 0.0).sum(axis=1)
        d_phi = slope.sum(axis=1) - d_psi
        # each side of the gap is matched in value and slope by its nearest pole
        a, b = d_near[live] - x[live], d_far[live] - x[live]
        last = live == k - 1
        c = f - a * d_psi - np.where(last, 0.0, b * d_phi)
        p = np.where(last, c * a + a * a * d_psi, (a + b) * f - a * b * (d_psi + d_phi))
        q = np.where(last, 0.0, a * b * f)
        with np.errstate(all="ignore"):
            # c * s^2 - p * s + q = 0, the root between the poles
            root = np.sqrt(np.maximum(p * p - 4 * c * q, 0.0))
            step = np.where(last, p / c, np.where(p > 0, 2 * q / (p + root), (p - root) / (2 * c)))
        new = x[live] + step
        good = np.isfinite(new) & (new > lo[live]) & (new < hi[live])
        x[live] = np.where(done, x[live], np.where(good, new, (lo[live] + hi[live]) / 2))
        live = live[~done]
        if not len(live):
            break
    return pole, x


def rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of ``vectors * values * vectors' + rho * u * u'``, rho > 0."""
    z = vectors.T @ u
    size = float(z @ z) * rho
    if size <= 0:
        return values, vectors
    tol = 8 * EPS * max(float(np.abs(values).max()), size)
    vectors = vectors.copy()
    # deflation: within equal eigenvalues a reflection puts all of z on the last one
    same = np.flatnonzero(np.diff(values) <= tol)
    if len(same):
        for run in np.split(same, np.flatnonzero(np.diff(same) > 1) + 1):
            at = slice(run[0], run[-1] + 2)
            v, norm = z[at].copy(), np.linalg.norm(z[at])
            if norm > 0:
                v[-1] += np.copysign(norm, v[-1])
                v /= np.linalg.norm(v)
                vectors[:, at] -= 2 * np.outer(vectors[:, at] @ v, v)
                sign = -np.copysign(norm, z[at][-1])
                z[at] = 0
                z[at.stop - 1] = sign
    # deflation: entries too small to move an eigenvalue
    on = np.flatnonzero(np.abs(z) * np.sqrt(rho * size) > tol)
    if not len(on):
        return values, vectors
    d, w = values[on], z[on]
    pole, x = secular_roots(d, w * w, rho)
    # roots less poles, without cancellation
    away = (d[pole][:, None] - d[None, :]) + x[:, None]
    # the vector of which the found roots are the exact ones
    k = len(on)
    ratio = away.copy()
    lower = np.arange(k)[:, None] < np.arange(k)[None, :]
    between = d[:, None] - d[None, :]
    shifted = np.vstack([between[1:], np.full((1, k), rho)])
    ratio = np.where(lower, ratio / np.where(lower, between, 1.0), ratio / np.where(lower, 1.0, shifted))
    exact = np.copysign(np.sqrt(np.abs(np.prod(ratio, axis=0))), w)
    q = exact[None, :] / -away
    q /= np.linalg.norm(q, axis=1)[:, None]
    values = values.copy()
    values[on] = d[pole] + x
    vectors[:, on] = vectors[:, on] @ q.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, mean, eigenvalues and eigenvectors of the scatter of some vectors."""

    def __init__(self, dim: int):
        self.n, self.mean, self.values, self.vectors = 0, np.zeros(dim), np.zeros(dim), np.eye(dim)

    def add(self, x: np.ndarray) -> None:
        apart = x - self.mean
        self.n += 1
        if self.n > 1:
            self.values, self.vectors = rank_one(self.values, self.vectors, apart, (self.n - 1) / self.n)
        self.mean = self.mean + apart / self.n

    def merge(self, other: "Spectrum") -> None:
        if not other.n:
            return
        if not self.n:
            self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors
            return
        n = self.n + other.n
        for e, v in zip(other.values, other.vectors.T):
            if e > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, v, float(e))
        apart = other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, apart, self.n * other.n / n)
        self.n, self.mean = n, self.mean + apart * (other.n / n)

    def row(self, node: int) -> dict:
        return {"node": node, "n": self.n, "mean": self.mean.tobytes(), "eigenvalues": self.values.tobytes(), "vectors": self.vectors.tobytes()}

    @classmethod
    def of(cls, row) -> "Spectrum":
        out = cls(0)
        out.n, out.mean, out.values = int(row.n), np.frombuffer(row.mean), np.frombuffer(row.eigenvalues)
        out.vectors = np.frombuffer(row.vectors).reshape(len(out.mean), -1)
        return out


SPECTRUM = "node long, n long, mean binary, eigenvalues binary, vectors binary"


def spectrum(fit: DataFrame, n: int, dim: int) -> Spectrum:
    """Spectrum of all n vectors of ``fit(x array<long>)``: one for each partition, combined in a tree."""
    def run(batches):
        from pyspark import TaskContext
        own = Spectrum(dim)
        for x in arrays(batches, dim):
            for v in x.astype(float):
                own.add(v)
        if own.n:
            yield pa.RecordBatch.from_pylist([own.row(TaskContext.get().partitionId())],
                                             pa.schema([("node", pa.int64()), ("n", pa.int64()), ("mean", pa.binary()), ("eigenvalues", pa.binary()), ("vectors", pa.binary())]))

    def combine(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        whole = Spectrum(dim)
        for row in rows.itertuples():
            whole.merge(Spectrum.of(row))
        return pd.DataFrame([whole.row(int(key[0]))])

    dealt = fit.repartition(max(1, min(PARTITIONS, -(-n // TAKEN))))
    level = written(dealt.mapInArrow(run, SPECTRUM), "whitening-spectra")
    while level.count() > 1:
        level = written(level.groupBy(F.floor(F.col("node") / FAN).cast("long").alias("up")).applyInPandas(combine, SPECTRUM), "whitening-spectra")
    found = level.collect()
    return Spectrum.of(found[0]) if found else Spectrum(dim)


def arrays(batches, dim: int) -> Iterator[np.ndarray]:
    """The column ``x`` of Arrow batches as (rows x dim) arrays of long."""
    for b in slices(batches, ROWS):
        x = column(b, "x")
        yield np.asarray(x.flatten()).reshape(len(x), dim)


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, x``: floor(scale * c) of each component of the usable vectors."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: c.cast("double")).alias("x"))
    v = v.where(_usable("x")).where(~F.exists("x", lambda c: F.abs(c * scale) >= 2.0 ** 53))
    return v.select("vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("x"))


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of each dimension."""
    def run(batches):
        for x in arrays(batches, dim):
            # 1024 rows of parts below 2 ** 32 cannot overflow
            yield pa.RecordBatch.from_arrays([pa.array([len(x)]), *(pa.array([p.sum(axis=0).tolist()]) for p in (x >> 31, x & 0x7FFFFFFF))],
                                             names=["n", "high", "low"])

    parts = fit.mapInArrow(run, "n long, high array<long>, low array<long>")
    n = fit.count()
    by = (parts.select(F.posexplode(F.arrays_zip("high", "low")).alias("i", "p")).groupBy("i")
          .agg(F.sum("p.high").alias("high"), F.sum("p.low").alias("low")).collect())
    sums = [0] * dim
    for r in by:
        sums[r.i] = (r.high << 31) + r.low
    return n, sums


def _matrix(fit: DataFrame, dim: int, rows: int, of) -> np.ndarray:
    """Sum over all vectors of the (rows x rows) matrix that ``of`` makes of an array of them."""
    def run(batches):
        total = np.zeros((rows, rows))
        for x in arrays(batches, dim):
            total += of(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows)), pa.array(list(total))], names=["i", "part"])

    # element by element, so that no task gathers the matrices of all partitions
    parts = fit.mapInArrow(run, "i long, part array<double>").select("i", F.posexplode("part").alias("j", "v"))
    out = np.zeros((rows, rows))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = r.v
    return out


def whiten(vectors: DataFrame, components: int = 4, scale: int = 256) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``
    for every usable row of ``vectors(vec_id, embedding)`` and each component.

    Rows whose vector is null or holds null or non-finite entries are left out,
    and so are those with an entry of 2^53 / scale or more, and those whose
    length is not the most frequent one (of equally frequent ones the
    longest). The fit counts each distinct integer vector once. There are at
    most ``components`` components, fewer where the vectors span fewer
    dimensions (eigenvalues under 1e-12 of their sum are none); an empty table,
    a single distinct vector and vectors without entries give no rows. Rows
    that repeat give repeated results, a null vec_id stays null, other columns
    are not looked at. ``deviation`` is exact, as ``decimal(38,0)``. A
    component's sign is that of its largest entry, made positive; of equal
    eigenvalues any basis may come.
    """
    spark = vectors.sparkSession
    table = written(integers(vectors, scale), "whitening-vectors")
    sizes = table.groupBy(F.size("x").alias("dim")).count().sort(F.desc("count"), F.desc("dim")).head(1)
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    dim = sizes[0].dim if sizes else 0
    if not dim:
        return spark.createDataFrame([], schema)
    table = table.where(F.size("x") == dim)
    fit = written(table.select("x").distinct(), "whitening-fit")
    n, sums = _sums(fit, dim)
    mean = np.array([s / n for s in sums])
    basis = spectrum(fit, n, dim).vectors
    basis = np.linalg.qr(basis)[0]

    def projected(x):
        y = (x - mean) @ basis
        return y.T @ y

    values, small = np.linalg.eigh(_matrix(fit, dim, dim, projected) / n)
    total = float(values.sum())
    top = [i for i in range(dim)[::-1][:components] if values[i] > NONE * total and values[i] > 0]
    if not top:
        return spark.createDataFrame([], schema)
    axes = (basis @ small)[:, top]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(top))])
    axes = axes / np.linalg.norm(axes, axis=0)
    explained, unit = (values[top] / total).tolist(), axes / np.sqrt(values[top])

    def white(x):
        y = (x - mean) @ unit
        return y.T @ y

    error = float(np.abs(_matrix(fit, dim, len(top), white) / n - np.eye(len(top))).max())
    whole = np.array(sums, object)

    def run(batches):
        from decimal import Decimal
        for b in slices(batches, ROWS):
            x = next(arrays([b], dim))
            # whole numbers: as longs where they fit, else as Python's
            bound = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums))
            kind = np.int64 if dim * bound * bound < 1 << 62 else object
            apart = x.astype(kind) * n - whole.astype(kind)
            deviation = (apart * apart).sum(axis=1).tolist()
            y, k = (x - mean) @ unit, len(top)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.arange(len(x)), k)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * k, n)), pa.array([Decimal(v) for v in deviation for _ in top], pa.decimal128(38, 0)),
                pa.array(y.ravel()), pa.array(explained * len(x)), pa.array(np.full(len(x) * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]).set_column(
                    0, "vec_id", column(b, "vec_id").take(pa.array(np.repeat(np.arange(len(x)), k))))

    return table.mapInArrow(run, schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {"op11_whitening": op11_whitening}
#: SQL has no eigenvectors
ORACLE: dict[str, str] = {}
