import heapq
from collections import Counter

from corpusflow.llm import mixing as M
from tests.llm.data import documents

SIZES = {"a": 600, "b": 150, "c": 35, None: 9}


def rows():
    out, i = [], 0
    for s, n in SIZES.items():
        for _ in range(n):
            out.append((i, f"t{i}", s))
            i += 1
    return out


def check(got, n, block):
    assert len(got) == n and len({r.position for r in got}) == n
    assert all(r.release <= r.slot < r.deadline for r in got)
    by_slot = {}
    for r in got:
        assert by_slot.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
    for s in {r.source for r in got}:
        mine = Counter(r.block for r in got if r.source == s)
        assert sorted(mine) == list(range(len(mine))) and all(mine[b] == block for b in list(sorted(mine))[:-1])


def test_less_than_one_block_deviation(spark):
    got = M.mix(documents(spark, rows()), block=3).collect()
    check(got, sum(SIZES.values()), 3)
    quota = {r.source: r.quota for r in M.quotas(spark.createDataFrame([(k or "", n) for k, n in SIZES.items()], "source string, n_docs long"),
                                                 None, 3).collect()}
    assert sum(quota.values()) == M.PARTS
    slots = sorted({(r.slot, r.source or "") for r in got if r.balanced})
    assert [s for s, _ in slots] == list(range(len(slots))) and len(slots) > 10
    served = Counter()
    for t, (_, s) in enumerate(slots, 1):
        served[s] += 1
        assert all(abs(served[k] - t * q / M.PARTS) < 1 for k, q in quota.items())


def test_given_weights(spark):
    got = M.mix(documents(spark, rows()), weights={"a": 1.0, "b": 3.0, "c": -2.0}, block=2).collect()
    check(got, sum(SIZES.values()), 2)
    first = Counter(r.source for r in got if r.slot < 60)
    assert first["b"] > 2.5 * first["a"] > 0 and first["c"] <= 2


def test_odd_rows(spark):
    odd = [(None, "x", "a"), (None, "x", "a"), (1, None, "b"), (1, None, "b"), (2, "", None)]
    df = documents(spark, odd)
    got = M.mix(df)
    assert set(got.columns) == {*df.columns, "release", "deadline", "slot", "balanced"}
    assert len({r.position for r in got.collect()}) == 5
    assert M.mix(documents(spark, [])).count() == 0
    one = M.mix(documents(spark, [(i, "t", "s") for i in range(20)])).collect()
    assert sorted(r.position for r in one) == list(range(20))


def deviations(spark, sizes, weights, block=2):
    """The schedule of the balanced part, held against the weights as given."""
    docs = documents(spark, [(i * 100_000 + k, "t", s) for i, (s, n) in enumerate(sizes.items()) for k in range(n)], clash=False)
    got = M.mix(docs, weights=weights, block=block).collect()
    check(got, sum(sizes.values()), block)
    slots, served, worst = sorted({(r.slot, r.source) for r in got if r.balanced}), Counter(), 0
    assert [s for s, _ in slots] == list(range(len(slots)))
    whole = sum(weights.get(s, 0) for s in sizes)
    for t, (_, s) in enumerate(slots, 1):
        served[s] += 1
        worst = max(worst, *(abs(served[k] - t * weights.get(k, 0) / whole) for k in sizes))
    return got, len(slots), worst


def test_target_weights_are_met(spark):
    _, n, worst = deviations(spark, {"a": 1800, "b": 200}, {"a": 0.9, "b": 0.1})
    assert n == 1000 and worst < 1
    many = {"a": 1000, **{f"s{i}": 50 for i in range(20)}}
    _, n, worst = deviations(spark, many, {s: 0.5 if s == "a" else 0.025 for s in many})
    assert n == 1000 and worst < 1
    # weights without a short period: parts follow the number of blocks
    _, n, worst = deviations(spark, {"a": 3000, "b": 1500, "c": 900}, {"a": 2 ** 0.5, "b": 0.7071, "c": 1 / 3})
    assert n > 1500 and worst < 2


def test_no_weight_comes_last(spark):
    got, _, worst = deviations(spark, {"a": 40, "b": 20, "c": 9, "d": 5}, {"a": 2.0, "b": 1.0, "c": 0.0})
    assert worst < 1
    assert max(r.slot for r in got if r.source in "ab") < min(r.slot for r in got if r.source in "cd")
    assert not any(r.balanced for r in got if r.source in "cd")


def test_more_sources_than_parts(spark):
    n = M.PARTS + 500
    df = spark.range(n * 3).selectExpr("id as doc_id", "'t' as text", f"concat('s', id % {n}) as source")
    got = M.mix(df, block=1).collect()
    check(got, n * 3, 1)
    assert sorted(r.slot for r in got) == list(range(n * 3)) and all(r.balanced for r in got)
    for turn in range(3):
        assert len({r.source for r in got if r.slot // n == turn}) == n
    sizes = {f"s{i}": 1 for i in range(n)} | {"big": 400}
    got = M.mix(documents(spark, [(i, "t", s) for i, s in enumerate(s for s, k in sizes.items() for _ in range(k))], clash=False), block=1).collect()
    check(got, n + 400, 1)


def earliest_deadline(quota, parts):
    """(rank, turn) -> slot, by a heap over one period."""
    jobs = sorted((j * parts // q, -(-(j + 1) * parts // q), r, j) for r, q in quota.items() for j in range(q))
    out, ready, at = {}, [], 0
    for slot in range(parts):
        while at < len(jobs) and jobs[at][0] <= slot:
            heapq.heappush(ready, jobs[at][1:])
            at += 1
        _, r, j = heapq.heappop(ready)
        out[r, j] = slot
    return out


def test_uneven_sources(spark):
    # many different quotas: every slot of the period, held against a heap
    counts = spark.range(1, 302).selectExpr("concat('s', id) as source", "id * id as n_docs")
    quota = M.quotas(counts, None, M.BLOCK).collect()
    parts = quota[0].parts
    assert parts == 2 * M.PARTS and sum(r.quota for r in quota) == parts and len({r.quota for r in quota}) > 10
    want = earliest_deadline({r.rank: r.quota for r in quota}, parts)
    rank = {r.source: r.rank for r in quota}
    got = M.period(M.quotas(counts, None, M.BLOCK), parts).collect()
    assert {(rank[r.source], j): s for r in got for j, s in enumerate(r.slots)} == want


def test_uneven_given_weights(spark):
    weights = {f"s{i}": i for i in range(1, 60)} | {"none": 0}
    counts = spark.createDataFrame([(s, 1000) for s in weights], "source string, n_docs long")
    quota = M.quotas(counts, weights, 1).collect()
    parts = sum(range(1, 60))
    want = earliest_deadline({r.rank: r.quota for r in quota if r.weighed}, parts)
    rank = {r.source: r.rank for r in quota if r.weighed}
    got = {r.source: r for r in M.period(M.quotas(counts, weights, 1), parts).collect()}
    assert {(rank[s], j): t for s in rank for j, t in enumerate(got[s].slots)} == want
    assert got["none"].slots == [0] and got["none"].base == 1000 * parts
