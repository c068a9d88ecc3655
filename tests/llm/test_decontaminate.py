import random
import re

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import decontaminate as D
from tests.llm.data import ODD, documents, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    w, hit, ids = split(text), set(), set()
    for i, t in items:
        b = split(t)
        n = min(13, len(b))
        for k in range(len(b) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == b[k:k + n]:
                    hit.update(range(p, p + n))
                    ids.add("" if i is None else str(i))
    return len(w), len(hit), sorted(ids)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, rng.choice([5, 13, 30, 45])))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "Only Two"), (None, " ".join(words(rng, 15))), (3, items[3][1]), (60, items[3][1])]
    rows = []
    for k in range(60):
        w = words(rng, rng.randint(0, 300))
        if k % 3 == 0:
            b = split(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(b) - 13))
            w[10:10] = [x.upper() + "," for x in b[a:a + rng.randint(10, 20)]]
        rows.append((k, " ".join(w)))
    rows += [(900, "say: only-two!"), (901, "Élan vital — ünï"), *ODD]
    return rows, items


def bench(spark, items):
    return spark.createDataFrame([(*x, None, None) for x in items], "item_id long, text string, hits string, items string")


@pytest.mark.parametrize("limit", [D.BROADCAST_BYTES, 400])  # one shard, and several passes
def test_against_brute_force(spark, case, limit):
    rows, items = case
    got = D.scan(documents(spark, rows), bench(spark, items), max_bytes=limit).withColumn("n_hit", D.n_hit()).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        assert (r.n_words, r.n_hit, list(r["items"])) == brute(text[r.doc_id], items), r.doc_id


@pytest.mark.parametrize("limit", [D.BROADCAST_BYTES, 400])
def test_clean_drops_by_the_twentieth(spark, case, limit):
    rows, items = case
    df = documents(spark, rows)
    out = D.clean(df, bench(spark, items), max_bytes=limit)
    assert out.columns == df.columns
    want = [d for d, t in rows if not (lambda n, h, _: h > 0 and 20 * h >= n)(*brute(t, items))]
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(map(str, want)) and len(want) < len(rows)


def test_remove_spans(spark):
    items = bench(spark, [(1, " ".join(f"b{i}" for i in range(13)))])
    hit = "é one, B0 " + "; ".join(f"b{i}" for i in range(1, 13)) + "! two"
    got = {r.doc_id: r for r in D.remove_spans(documents(spark, [(1, hit), (2, "b0 b1"), (3, None)]), items).collect()}
    assert got[1].text == "é one, ! two" and got[1].n_hit == 13 and got[2].text == "b0 b1" and got[3].text is None


def test_empty_tables(spark, case):
    rows, items = case
    assert D.scan(documents(spark, []), bench(spark, items)).count() == 0
    assert D.clean(documents(spark, rows), bench(spark, [])).count() == len(rows)


@pytest.mark.parametrize("limit", [D.BROADCAST_BYTES, 400])
def test_odd_column_names(spark, case, limit):
    rows, items = case
    docs = documents(spark, rows, clash=False).withColumn("dc:title x", F.lit("t")).withColumn("1st, of: <two>", F.lit(1))
    want = {i for i, t in rows for n, hit, _ in [brute(t, items)] if not (hit and 20 * hit >= n)}
    got = D.clean(docs, bench(spark, items), max_bytes=limit)
    assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == want
