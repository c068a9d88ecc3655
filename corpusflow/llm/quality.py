"""Quality classifier on random Fourier features (operator 3).

Statistics of a text (character classes, word shapes, repetition) are
standardised and mapped to cosines of random projections, whose inner products
approximate a Gaussian kernel. Every partition sums its share of the normal
equations, the shares are added up in a tree, and the ridge weights are solved
from one small matrix. A second fold of labelled rows calibrates the raw
scores: they are counted in fixed bins and an isotonic (pool adjacent
violators) fit over the bins gives the probability of label 1.

Labels are learnt only from rows whose crc32(doc_id as text) mod 5 is not 0:
folds 2-4 fit the ridge weights, fold 1 the calibration, fold 0 is held out.
All labelled rows of those folds are used. Features are rounded to multiples
of 2**-12, so that sums are exact and do not depend on the order of tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import column, read, slices, utf8, written

#: fixed layout of the statistics
STATS = ("has_text", "log_words", "word_len", "upper", "lower", "digit", "space", "newline", "high_bytes",
         "sentence_marks", "commas", "bang_quest", "symbols", "brackets", "quotes", "distinct_words",
         "distinct_pairs", "distinct_lines", "entropy", "long_words", "doubled")
FEATURES = 256
SEED = 20240607
RIDGE = 1e-4
BINS = 2048
CUT = 0.3
FOLDS = 5

_CLASS = np.zeros((256, 11), dtype=np.float64)
for _k, _set in enumerate((range(65, 91), range(97, 123), range(48, 58), b" \t", b"\r\n", range(128, 256),
                           b".", b",", b"!?", b"#$%&*+/<=>@\\^_`|~", b"()[]{}")):
    _CLASS[list(_set), _k] = 1.0


def statistics(text: bytes | None) -> list[float]:
    """The statistics of one text; all 0 for a null or empty one."""
    if not text:
        return [0.0] * len(STATS)
    raw = np.frombuffer(text, np.uint8)
    n = len(raw)
    freq = np.bincount(raw, minlength=256) / n
    upper, lower, digit, space, line, high, stop, comma, bang, symbol, bracket = (freq @ _CLASS).tolist()
    some = freq[freq > 0]
    words, lines = text.split(), text.split(b"\n")
    w = len(words)
    pairs = len(set(zip(words, words[1:])))
    return [1.0, math.log1p(w), n / (w + 1), upper, lower, digit, space, line, high, stop, comma, bang, symbol, bracket,
            float(freq[34] + freq[39]), len(set(words)) / max(1, w), pairs / max(1, w - 1), len(set(lines)) / len(lines),
            float(-(some * np.log(some)).sum()), sum(len(x) > 16 for x in words) / max(1, w),
            float(np.count_nonzero(raw[1:] == raw[:-1])) / n]


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id, stats`` of every row of ``docs(doc_id, text)``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in slices(batches):
            stats = [statistics(t) for t in utf8(b, "text")]
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(stats, pa.list_(pa.float64()))],
                                             names=["doc_id", "stats"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, stats array<double>")


def fold() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


@dataclass
class Model:
    """Everything a task needs to score; its size does not depend on the data."""
    mean: np.ndarray
    scale: np.ndarray
    freq: np.ndarray
    phase: np.ndarray
    weight: np.ndarray
    at: np.ndarray
    value: np.ndarray

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        f = np.rint(np.cos(z @ self.freq + self.phase) * 4096) / 4096
        return np.hstack([f, np.ones((len(f), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        # rounded, so that the size of a batch does not show in the last bits
        return np.round(self.fourier(stats) @ self.weight, 9)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.at, self.value)


def _matrix(col: pa.Array) -> np.ndarray:
    return np.asarray(col.flatten(), dtype=np.float64).reshape(len(col), len(STATS))


def _add_up(parts: DataFrame, size: int, fan_in: int = 16) -> np.ndarray:
    """The sum of one packed vector per row, ``fan_in`` partitions at a time."""
    def run(batches):
        total = np.zeros(size)
        for b in batches:
            for blob in column(b, "sums").to_pylist():
                total += np.frombuffer(blob)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    n = parts.rdd.getNumPartitions()
    while n > fan_in:
        n = math.ceil(n / fan_in)
        parts = parts.repartition(n).mapInArrow(run, "sums binary")
    total = np.zeros(size)
    for row in parts.toLocalIterator():
        total += np.frombuffer(row[0])
    return total


def isotonic(at: np.ndarray, rows: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit of ``ones / rows`` by pooling adjacent violators:
    centres of the pooled blocks and their values."""
    blocks: list[list[float]] = []  # rows, ones, sum of places
    for a, n, k in zip(at, rows, ones):
        blocks.append([n, k, a * n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last)]
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


def fit(stats: DataFrame, labels: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = SEED) -> Model:
    """A model from ``stats(doc_id, stats)`` and ``labels(doc_id, quality)``.

    Labels that are null or neither 0 nor 1 take no part; a document with
    several label rows counts once for each. Without any usable label every
    score is 0.5.
    """
    y = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold() != 0)) \
        .select(F.col("doc_id").alias("label_id"), F.col("quality").cast("double").alias("y"))
    data = written(stats.join(y, F.col("doc_id") == F.col("label_id")).select(fold().alias("fold"), "stats", "y"), "quality")
    d = len(STATS)
    item = [F.col("stats")[i] for i in range(d)]
    got = data.where("fold > 1").agg(F.count(F.lit(1)), *(F.avg(x) for x in item), *(F.stddev_pop(x) for x in item)).first()
    rng = np.random.default_rng(seed)
    model = Model(np.zeros(d), np.ones(d), rng.normal(size=(d, features)) / math.sqrt(2 * d),
                  rng.uniform(0, 2 * math.pi, features), np.zeros(features + 1), np.array([0.0]), np.array([0.5]))
    if not got[0]:
        return model
    # rounded, so that the order of tasks does not show in the last bits
    model.mean = np.round(np.array(got[1:d + 1]), 9)
    model.scale = np.round(np.array(got[d + 1:]), 9)
    model.scale[model.scale < 1e-6] = 1.0
    size = features + 1

    def equations(batches):
        left, right = np.zeros((size, size)), np.zeros(size)
        for b in slices(batches, 2048):
            x = model.fourier(_matrix(column(b, "stats")))
            left += x.T @ x
            right += x.T @ np.asarray(column(b, "y"))
        yield pa.RecordBatch.from_arrays([pa.array([np.append(left.ravel(), right).tobytes()], pa.binary())], names=["sums"])

    total = _add_up(data.where("fold > 1").select("stats", "y").mapInArrow(equations, "sums binary"), size * size + size)
    left, right = total[:-size].reshape(size, size), total[-size:]
    model.weight = np.linalg.solve(left + ridge * got[0] * np.eye(size), right)

    def binned(batches):
        count = np.zeros((BINS, 2))
        for b in slices(batches, 2048):
            k = np.clip(((model.raw(_matrix(column(b, "stats"))) + 1) / 3 * BINS).astype(int), 0, BINS - 1)
            np.add.at(count, (k, 0), 1)
            np.add.at(count, (k, 1), np.asarray(column(b, "y")))
        yield pa.RecordBatch.from_arrays([pa.array([count.tobytes()], pa.binary())], names=["sums"])

    count = _add_up(data.where("fold = 1").select("stats", "y").mapInArrow(binned, "sums binary"), BINS * 2).reshape(BINS, 2)
    used = np.flatnonzero(count[:, 0])
    if len(used):
        model.at, model.value = isotonic((used + 0.5) / BINS * 3 - 1, count[used, 0], count[used, 1])
    else:  # no row to calibrate on: the ridge fit itself, held to 0..1
        model.at, model.value = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def score(stats: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """``doc_id, score, predicted`` of every row of ``stats(doc_id, stats)``."""
    id_type = stats.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in slices(batches, 2048):
            s = model.score(_matrix(column(b, "stats")))
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(s), pa.array((s >= cut).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    return stats.mapInArrow(run, f"doc_id {id_type}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text)``.

    Only the text is an input of the score. Null and empty texts are scored
    like others (all statistics 0); a null doc_id is scored and is not held
    out; repeated rows give repeated results; other columns are not looked at.
    """
    stats = written(measure(docs), "quality")
    return score(stats, fit(stats, labels), cut).select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject.

    Texts are measured again rather than joined to their scores, so no text is
    shuffled.
    """
    model = fit(written(measure(docs), "quality"), labels)

    def run(batches):
        for b in slices(batches):
            found = model.score(np.array([statistics(t) for t in utf8(b, "text")]))
            yield b.filter(pa.array(found >= cut))

    return docs.mapInArrow(run, docs.schema)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {"op3_quality": op3_quality}
ORACLE: dict[str, str] = {}
