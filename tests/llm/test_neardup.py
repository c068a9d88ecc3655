import numpy as np
import pytest

from corpusflow.llm import neardup as N
from tests.llm.data import ODD, corpus, documents


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + min(k, len(w))]) for i in range(len(w) - min(k, len(w)) + 1)} if w else set()


def brute(rows, k, percent=80):
    sets = {d: shingle_set(t, k) for d, t in rows if d is not None}
    group = {d: d for d in sets}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    return {d: (len(sets[d]), root(d), root(d) == d) for d in ids}


@pytest.mark.parametrize("k", [2, 5])
def test_against_all_pairs(spark, k):
    rows = [*enumerate(corpus(seed=k, n=90)), *ODD]
    got = N.near_duplicates(documents(spark, rows), k).collect()
    want = brute(rows, k)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id]
    assert any(not r.kept for r in got)


def test_chain_links_through_the_middle(spark):
    base = [f"w{i}" for i in range(101)]
    steps = [" ".join(base[:i] + [f"z{j}" for j in range(i)] + base[i:]) for i in (0,)]
    rows, w = [(0, " ".join(base))], list(base)
    for d in range(1, 8):  # each differs from the one before in a few words, the last from the first in many
        for i in range(4):
            w[(d * 12 + i) % 101] = f"n{d}_{i}"
        rows.append((d, " ".join(w)))
    got = {r.doc_id: r.component_id for r in N.near_duplicates(documents(spark, rows), 2).collect()}
    assert got == {d: v[1] for d, v in brute(rows, 2).items()} and set(got.values()) == {0} and steps


def test_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:i % 200] + [f"x{i}"] + base[i % 200 + 1:])) for i in range(400)]
    got = N.near_duplicates(documents(spark, rows), 5)
    assert {(r.component_id, r.kept) for r in got.where("doc_id > 0").collect()} == {(0, False)}


def test_empty_table(spark):
    assert N.near_duplicates(documents(spark, []), 2).count() == 0


@pytest.mark.parametrize("samples, words, other", [(N.SAMPLES, N.SKETCH_WORDS, 0.1), (N.SHARP_SAMPLES, N.SHARP_WORDS, 0.68)])
def test_sketch_tells_similarities_apart(samples, words, other):
    rng = np.random.default_rng(1)
    limit = N.sketch_limit(samples, words * 64, 80)
    far = near = 0
    for _ in range(100):
        a = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
        near_by, apart = (np.concatenate([a[:int(1800 * j / (1 + j))], rng.integers(0, 1 << 63, 900 - int(1800 * j / (1 + j)), dtype=np.uint64)])
                          for j in (0.801, other))
        o = N.odd_sketches(np.array([N.min_hashes(x, samples) for x in (a, near_by, apart)]), words)
        bits = [int(np.bitwise_count(o[0] ^ o[i]).sum()) for i in (1, 2)]
        near += bits[0] <= limit
        far += bits[1] <= limit
    assert near == 100 and far <= 4


def test_deduplicated_keeps_columns_and_clean_rows(spark):
    rows = [(3, "a b c d e f g"), (1, "a b c d e f g"), (2, "other words than these ones here now"), (None, "a b c d e f g"), (4, None)]
    df = documents(spark, rows)
    out = N.deduplicated(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 1, 2, 4]


def test_group_at_the_threshold_makes_few_pairs(spark, monkeypatch):
    """Copies with two words changed lie around the threshold: what is confirmed
    in the second pass is little more than its links, not the group's square."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        w = [f"w{j}" for j in range(40)]
        for j in rng.choice(40, 2, replace=False):
            w[j] = f"x{i}_{j}"
        rows.append((i, " ".join(w)))
    made, keep = [], N.written

    def counting(df, tag):
        out = keep(df, tag)
        made.extend([out.count()] if tag in ("neardup-pairs", "neardup-links") else [])
        return out

    monkeypatch.setattr(N, "written", counting)
    got = {r.doc_id: r.component_id for r in N.near_duplicates(documents(spark, rows), 2).collect()}
    assert got == {d: v[1] for d, v in brute(rows, 2).items()}
    star, _, second, links = made
    assert star <= 4 * len(rows) and second <= 1.3 * links + 20


@pytest.mark.parametrize("n", [3, 40, 700, 4096])
def test_whole_set_sketch_never_loses_a_link(n):
    rng = np.random.default_rng(n)
    for both in (1.0, 0.9, 0.8, 0.7):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.unique(np.concatenate([a[:round(2 * n * both / (1 + both))], rng.integers(0, 1 << 63, n - round(2 * n * both / (1 + both)), dtype=np.uint64)]))
        a = np.unique(a)
        x, y = N.set_sketches([a, np.empty(0, np.uint64), b])[[0, 2]]
        bits, apart = int(np.bitwise_count(x ^ y).sum()), len(np.setxor1d(a, b))
        assert bits <= apart and (bits >= 0.9 * apart - 2 or apart > 200)
        if both == 0.7 and 40 <= n:
            assert bits * 180 > (len(a) + len(b)) * 20


def test_long_texts_of_like_size_on_both_sides_of_the_whole_limit(spark):
    base = [f"w{i}" for i in range(N.WHOLE)]
    rows = []
    for i in range(8):  # 4000 to 4280 shingles, each near the next
        w = base[:4000 + 40 * i] if 4000 + 40 * i <= N.WHOLE else base + [f"y{j}" for j in range(4000 + 40 * i - N.WHOLE)]
        rows.append((i, " ".join(f"z{i}_{j}" if j % 25 == i else x for j, x in enumerate(w))))
    got = {r.doc_id: r.component_id for r in N.near_duplicates(documents(spark, rows), 2).collect()}
    assert got == {d: v[1] for d, v in brute(rows, 2).items()}
