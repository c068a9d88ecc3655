import random

import numpy as np
import pytest
import xxhash

from corpusflow.llm import simhash as S
from tests.llm.data import ODD, corpus, documents


def brute_print(text, k=3):
    w = (text or "").encode().lower().split()
    m = min(k, len(w))
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + m]), 42) for i in range(len(w) - m + 1)] if w else []
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute_components(prints, distance=3):
    """Smallest doc_id reachable of each doc_id of (doc_id, print) rows."""
    of = {}
    for d, p in prints:
        of.setdefault(d, set()).add(p)
    group = {d: d for d in of}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    ids = sorted(of)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if any((x ^ y).bit_count() <= distance for x in of[a] for y in of[b]):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    return {d: root(d) for d in ids}


def test_against_all_pairs(spark):
    rows = [*enumerate(corpus(seed=3, n=120)), *ODD, (7, "another text for an id that is there before"), (2001, "One  Two"), (2002, "one two")]
    got = S.simhash_groups(documents(spark, rows)).collect()
    prints = [(d, brute_print(t)) for d, t in rows]
    want = brute_components([x for x in prints if x[0] is not None])
    assert len(got) == len(rows)
    assert sorted(((r.doc_id or -1), r.print % 2**64) for r in got) == sorted(((d or -1), p) for d, p in prints)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
    assert len({r.component_id for r in got}) < len(rows) - 20


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_grid_against_all_pairs(spark, distance, monkeypatch):
    """Fingerprints around a few centres, at every number of differing bits."""
    rng = random.Random(distance)
    prints, n = [], 0
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            flips = rng.sample(range(64), rng.randint(0, 7))
            prints.append((n, centre ^ sum(1 << i for i in flips)))
            n += 1
    table = spark.createDataFrame([(d, S.signed(p)) for d, p in prints], "doc_id long, print long")
    monkeypatch.setattr(S, "fingerprints", lambda docs, shingle: docs)
    got = {r.doc_id: r.component_id for r in S.simhash_groups(table, distance=distance).collect()}
    assert got == brute_components(prints, distance)


def test_counts_bound_the_differing_bits(spark):
    rng = np.random.default_rng(4)
    p = rng.integers(0, 1 << 63, 200, dtype=np.int64) * rng.choice([1, -1], 200)
    rows = spark.createDataFrame([(int(x),) for x in p], "print long").select("print", S.segment_counts(S.F.col("print")).alias("c")).collect()
    for r in rows:
        u, c = r["print"] % 2**64, r.c % 2**64
        assert [(c >> 2 * i) & 3 for i in range(32)] == [(u >> 2 * i & 3).bit_count() for i in range(32)]


def test_large_group_makes_few_links(spark):
    """Many fingerprints in a few bits: the stars join them, the grid finds nothing to add."""
    base = 0x0123456789ABCDEF
    points = spark.createDataFrame([(i, S.signed(base ^ (i << 20))) for i in range(2000)], "rep long, print long")
    edges = S.clique_edges(points, 3)
    assert edges.count() <= 22 * 2000
    one = S.components(edges).toDF("rep", "component")
    assert one.select("component").distinct().collect() == [(0,)]
    assert S.grid_links(points.join(one, "rep"), 3).count() == 0


def test_empty_table_and_long_text(spark):
    assert S.simhash_groups(documents(spark, [])).count() == 0
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    assert S.fingerprint(long.encode(), 3) == brute_print(long)
    with pytest.raises(ValueError):
        S.simhash_groups(documents(spark, []), distance=4)
