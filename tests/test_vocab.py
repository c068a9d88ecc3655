"""Merge-based subwords against rounds on lists of strings, a word at a time."""

import random
from collections import Counter

import pytest

from corpusflow.operators import vocab as V

MARK = "▁"


def listed(counts, size, per_round):
    """Pieces of each word and the rounds, from the definition."""
    words = {w: list(MARK + w) for w in counts}
    chars, rounds = {c for p in words.values() for c in p}, []
    n = len(chars)
    while (budget := size - 2 - n) > 0:
        pairs = Counter()
        for w, p in words.items():
            for pair in zip(p, p[1:]):
                pairs[pair] += counts[w]
        top = sorted(pairs, key=lambda p: (-pairs[p], p))[:4 * per_round]
        if not (chosen := V.choose_round(top, min(per_round, budget))):
            break
        rounds.append(chosen)
        n += len(chosen)
        words = {w: V.merge_round(p, chosen) for w, p in words.items()}
    return words, rounds, chars | {p for r in rounds for p in r.values()}


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("aab¼é😀c") for _ in range(rng.randint(1, 9))) for _ in range(120)] + ["aaaa", "aaaaa", "aaaaaaaa"]
    rows = [" ".join(rng.choices(words, k=rng.randint(0, 9))) for _ in range(200)] + ["  two \t white\nspace ", "", None]
    return spark.createDataFrame(list(enumerate(rows)), "k long, text string")


@pytest.mark.parametrize("size,per_round", [(30, 1), (60, 3), (500, 200), (5, 200)])
def test_rounds_are_those_of_the_definition(texts, size, per_round):
    counts = Counter(w for r in texts.collect() for w in (r.text or "").split())
    words, rounds, pieces = listed(counts, size, per_round)
    vocab, table, got = V.train_subwords(texts, size, per_round)
    assert got == rounds and {r.word: r.pieces for r in table.collect()} == words
    assert {r.piece for r in vocab.collect()} == pieces | {"</s>", "<unk>"}
    coded = {r.k: r.pieces for r in V.encode(texts, table, got, "k").collect()}
    assert coded == {r.k: [p for w in r.text.split() for p in words[w]] for r in texts.collect() if (r.text or "").split()}


def test_word_table_is_not_written_each_round(texts, monkeypatch):
    """A pass for each round, a new table only every ``REPLAYED``."""
    tables, written = [], V._written
    monkeypatch.setattr(V, "_written", lambda df: tables.append(1) or written(df))
    rounds = V.train_subwords(texts, 60, 1)[2]
    assert len(rounds) > V.REPLAYED and len(tables) == 2 + (len(rounds) - 1) // V.REPLAYED


def test_unseen_words_and_repeated_keys(spark, texts):
    _, table, rounds = V.train_subwords(texts, 40, 5)

    def one(word):
        p = list(MARK + word)
        for r in rounds:
            p = V.merge_round(p, r)
        return p

    df = spark.createDataFrame([("x", "aab Ωaa"), ("x", "漢字 aab c"), (None, "aaaaaaaaaaa"), ("y", None), ("z", " "), ("x", None)], "k string, text string")
    got = {r.k: r.pieces for r in V.encode(df, table, rounds, "k").collect()}
    turns = [p for w in [*sorted(["aab", "漢字"], key=one), *sorted(["Ωaa", "aab"], key=one), "c"] for p in one(w)]
    assert got == {"x": turns, None: one("aaaaaaaaaaa")}


def test_encoding_no_words(spark):
    _, table, rounds = V.train_subwords(spark.createDataFrame([("",), (None,)], "text string"), 10)
    assert table.count() == 0 and rounds == []
    assert V.encode(spark.createDataFrame([(1, "")], "k int, text string"), table, rounds, "k").count() == 0
