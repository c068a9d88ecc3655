import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from corpusflow.llm import repeats as R
from tests.llm.data import ODD, corpus, documents


def brute(rows):
    least = {}
    for d, t in rows:
        raw = (t or "").encode()
        if d is not None:
            for i in range(len(raw) - 49):
                s = raw[i:i + 50]
                least[s] = min(d, least.get(s, d))
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 2, bool)
        if d is not None:
            for i in range(len(raw) - 49):
                if least[raw[i:i + 50]] < d:
                    gone[i + 1:i + 51] = True
        spans = int((gone[1:] & ~gone[:-1]).sum())
        kept = bytes(b for b, g in zip(raw, gone[1:]) if not g)
        out.append((str(d), len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(spark, rows, **options):
    got = R.remove_repeats(documents(spark, rows), with_kept=True, **options).collect()
    for r in got:
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and sum(r.spans[1::2]) - sum(r.spans[::2]) == r.n_removed
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans) // 2, r.kept_sha256) for r in got)


def cases():
    rng = random.Random(12)
    texts = corpus(seed=3, n=60)
    whole = " ".join(texts)
    for _ in range(40):  # cut and glued, so that every kind of border occurs
        parts = [whole[(a := rng.randrange(len(whole))):a + rng.choice([20, 49, 50, 51, 60, 84, 85, 200])] for _ in range(rng.randint(1, 5))]
        texts.append(rng.choice(["", "é", "x"]).join(parts))
    texts += ["a" * 300, "a" * 49, "a" * 50, "b" + "a" * 51, "ab" * 60, "\0" * 120, "x" + "\0" * 70, "ü" * 40, "ü" * 25]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return [*zip(ids, texts), (5000, texts[0]), (5000, texts[0]), (-7, texts[1]), *(r for r in ODD if r[0] != 1004), (1004, "long " * 300)]


# hot_chunks 2 and 1: phrases sent window by window; sort_windows 1: a trigger at a time
@pytest.mark.parametrize("options", [{}, {"hot_chunks": 2, "sort_windows": 1}, {"hot_chunks": 1}, {"sort_windows": 1}])
def test_against_brute_force(spark, options):
    rows = cases()
    assert run(spark, rows, **options) == brute(rows)


def test_parse_covers_every_window_once():
    rng = np.random.default_rng(2)
    for n in (0, 49, 50, 51, 85, 1000):
        raw = rng.integers(0, 3, n).astype(np.uint8).tobytes()
        _, a, b = R.parse(raw)
        assert [i for x, y in zip(a, b) for i in range(x, y + 1)] == list(range(max(0, n - 49)))


def test_marks_give_the_parse_of_many_texts(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, k, n).astype(np.uint8).tobytes() for n in (0, 49, 50, 51, 77, 300, 1000) for k in (1, 2, 200)]
    parsed = [R.parse(t) for t in texts]
    monkeypatch.setattr(R, "BLOCK", 29)  # the same in pieces
    size = np.array([len(t) for t in texts])
    start = np.cumsum(size + 1) - size - 1
    marked = [R.marks(t) for t in texts]
    at, first, last = R.phrases(np.frombuffer(b"".join(marked), np.uint8), np.array([len(m) for m in marked]), start, size)
    assert first.tolist() == [i + s for (_, a, _), s in zip(parsed, start.tolist()) for i in a.tolist()]
    assert last.tolist() == [i + s for (_, _, b), s in zip(parsed, start.tolist()) for i in b.tolist()]
    assert ((first <= last) & (at >= last) & (at + R.GRAM <= first + R.WIDTH)).all()
    for text, (g, a, b) in zip(texts, parsed):
        assert all(np.array_equal(x, y) for x, y in zip(R.parse(text), (g, a, b)))


def test_what_very_many_chunks_share_is_not_sent_window_by_window():
    """A passage in 140 chunks: what they send stays a small multiple of their text."""
    rng, shards = random.Random(5), 3
    passage = rng.randbytes(4000).hex()
    fields = {"chunk": pa.int32(), "doc_id": pa.int64(), "hash": pa.int64(), "shard": pa.int32()} | {
        c: pa.binary() for c in ("shared", "hot", "gone", "ask", "windows")}
    empty = pa.schema(fields).empty_table()
    batches = [pa.RecordBatch.from_pydict({"chunk": pa.array([k], pa.int32()), "doc_id": [k], "text": [(passage + rng.randbytes(500).hex()).encode()]})
               for k in range(140)]
    tables = [pa.Table.from_batches(R._packed([b])) for b in batches]
    sent = pa.concat_tables([R._round_one(shards)(t, empty) for t in tables])
    rows = [r for p in range(shards) for r in R._repeated(R.HOT_CHUNKS)(sent.filter(pyarrow.compute.equal(sent["shard"], p))).to_pylist()]
    entries = 0
    for k, t in enumerate(tables):
        answers = pa.Table.from_pylist([dict.fromkeys(fields) | r for r in rows if r["chunk"] == k], schema=empty.schema)
        entries += R._round_two(shards)(t, answers).nbytes
    assert entries < 4 * sum(b["text"].nbytes for b in batches)


def test_empty_table(spark):
    assert R.remove_repeats(documents(spark, [])).count() == 0
