"""Unigram subwords against an exhaustive EM: all segmentations of every word are listed."""

import math
import random
from collections import Counter

import pytest

from corpusflow.operators import unigram as U
from corpusflow.operators.vocab import word_counts

MARK = "▁"


def segmentations(word, pieces):
    if not word:
        return [[]]
    return [[word[:n], *rest] for n in range(1, len(word) + 1) if word[:n] in pieces for rest in segmentations(word[n:], pieces)]


def listed_expectation(counts, scores):
    """Expected piece counts and log likelihood by listing all segmentations."""
    out, total = Counter(), 0.0
    for word, n in counts.items():
        ways = [(s, math.exp(sum(scores[p] for p in s))) for s in segmentations(MARK + word, scores)]
        whole = sum(p for _, p in ways)
        total += n * math.log(whole)
        for s, p in ways:
            for piece in s:
                out[piece] += n * p / whole
    return out, total


def corpus(seed=0, n=400):
    rng = random.Random(seed)
    stems, ends = ["lo", "war", "new", "wid", "as"], ["", "er", "est", "s", "ing"]
    return [" ".join(rng.choice(stems) + rng.choice(ends) for _ in range(rng.randint(0, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    rows = corpus() + ["  odd \t white\nspace ", "", "é¼ 😀x 😀x"]
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)] + [(9999, None)], "k long, text string")


@pytest.fixture(scope="module")
def counts(texts):
    return Counter(w for r in texts.collect() for w in (r.text or "").split())


def test_seeds(texts, counts):
    words = word_counts(texts.where("text is not null"))
    want = Counter()
    for w, n in counts.items():
        m = MARK + w
        for i in range(len(m)):
            for j in range(i + 1, min(len(m), i + U.LONGEST) + 1):
                want[m[i:j]] += n
    chars = {p: n for p, n in want.items() if len(p) == 1}
    best = sorted((p for p, n in want.items() if len(p) > 1 and n > 1), key=lambda p: (-want[p] * len(p), p))[:25]
    assert {r.piece: r.freq for r in U.seed_pieces(words, 25).collect()} == chars | {p: want[p] for p in best}


def test_expectation_against_all_segmentations(texts, counts):
    words = word_counts(texts.where("text is not null")).repartition(3)
    seeds = {r.piece: r.freq * len(r.piece) for r in U.seed_pieces(words, 60).collect()}
    scores = {p: math.log(n / sum(seeds.values())) for p, n in seeds.items()}
    for _ in range(3):
        model = U.Model(list(scores), scores.values())
        got, likelihood = U.expected_counts(words, model)
        want, total = listed_expectation(counts, scores)
        assert likelihood == pytest.approx(total, rel=1e-12)
        assert got == pytest.approx({p: c for p, c in want.items()}, rel=1e-9)
        new = U.maximised(got, [p for p in scores if len(p) == 1])
        scores = dict(zip(new.pieces, new.scores))
        best = U.best_counts(words, new)
        listed = Counter()
        for w, n in counts.items():
            top = max(sum(scores[p] for p in s) for s in segmentations(MARK + w, scores))
            mine = [new.pieces[i] for *_, i in new.best(MARK + w)]
            assert sum(scores[p] for p in mine) == pytest.approx(top)
            listed.update({p: n * c for p, c in Counter(mine).items()})
        assert best == dict(listed)


def test_words_side_by_side_are_as_one_by_one(monkeypatch):
    """The sums of a batch of words against those of each word alone, and long words by themselves."""
    rng = random.Random(5)
    words = ["".join(rng.choice("aab¼é😀c漢") for _ in range(rng.randint(0, 14))) for _ in range(300)] + ["a" * 90]
    pieces = sorted({w[i:i + n] for w in words for n in (1, 2, 3, 5) for i in range(0, len(w) - n, 3)} - {"漢", ""})
    # equal scores, so that ties are met
    model = U.Model(pieces, [-1.0 - rng.randint(1, 3) * len(p) ** 0.5 for p in pieces])
    marked, times = [MARK + w for w in words], U.np.arange(1.0, len(words) + 1)
    scores = U.np.array([*model.scores, model.unknown])
    lattices = U.Lattices(U.Trie(pieces), marked)
    expected, best = U.np.zeros(len(pieces)), U.np.zeros(len(pieces))
    said = lattices.expect(scores, times, expected)
    lattices.best(scores, times, best)
    want, listed = {}, Counter()
    assert said.tolist() == pytest.approx([model.expect(w, n, want) for w, n in zip(marked, times)])
    assert expected.tolist() == pytest.approx([want.get(i, 0.0) for i in range(len(pieces))])
    for w, n in zip(marked, times):
        listed.update({i: n * c for i, c in Counter(i for *_, i in model.best(w)).items()})
    assert best.tolist() == [listed.get(i, 0) for i in range(len(pieces))]
    empty = U.Lattices(U.Trie(pieces), [])
    assert len(empty.expect(scores, times[:0], expected)) == 0


def test_long_words_and_short_ones_add_up(texts, monkeypatch):
    words = word_counts(texts.where("text is not null"))
    model = U.Model(list("▁lowarneidstg") + ["er", "▁lo"], [-2.0 - i / 10 for i in range(15)])
    whole = U.expected_counts(words, model), U.best_counts(words, model)
    long = words.unionByName(words.selectExpr("repeat(word, 60) AS word", "0L AS cnt"))
    counts, likelihood = U.expected_counts(long, model)
    assert likelihood == pytest.approx(whole[0][1]) and counts == pytest.approx(whole[0][0])
    assert U.best_counts(long, model) == whole[1]


def test_pruning_keeps_what_costs_most(counts):
    """The loss of a piece against the likelihood of segmentations made anew without it."""
    scores = {p: math.log(f) for p, f in {"▁": .1, "l": .1, "o": .1, "w": .1, "e": .1, "r": .1, "lo": .1, "low": .12, "er": .13, "we": .02}.items()}
    words = Counter({"lower": 30, "low": 20, "we": 2, "lo": 3})
    model = U.Model(list(scores), scores.values())
    best = Counter()
    for w, n in words.items():
        best.update({model.pieces[i]: n * c for i, c in Counter(i for *_, i in model.best(MARK + w)).items()})
    chars = {p for p in scores if len(p) == 1}
    order = [(set(U.pruned(model, best, len(chars) + k).pieces) - chars) for k in range(4)]
    assert order[0] == set() and all(a < b for a, b in zip(order, order[1:3]))

    def likelihood(counts):
        total = sum(counts.values())
        return sum(n * math.log(n / total) for n in counts.values() if n)

    def without(p):
        new = Counter(best)
        n = new.pop(p, 0)
        for *_, i in model.best(p, without=model.at[p]):
            new[model.pieces[i]] += n
        return likelihood(best) - likelihood(new)

    # the estimate leaves out what happens to the other pieces, so only a plain order is held
    assert max(("low", "er", "lo", "we"), key=without) in order[1]


def test_training_raises_likelihood_and_meets_size(texts, counts):
    vocab, model, said = U.train(texts, size=40, seeds=120)
    rows = vocab.collect()
    assert len(rows) == 40 and [r.id for r in sorted(rows, key=lambda r: r.id)] == list(range(40))
    assert {r.piece: r.id for r in rows if r.id < 2} == {"</s>": 0, "<unk>": 1}
    assert {c for w in counts for c in MARK + w} <= set(model.pieces)
    assert said[1] > said[0] and len({"▁new", "▁war", "▁wid", "▁lo", "▁as"} & set(model.pieces)) >= 3
    # the words take far fewer pieces than characters
    pieces = sum(n * len(model.best(MARK + w)) for w, n in counts.items())
    assert pieces < 0.6 * sum(n * (len(w) + 1) for w, n in counts.items())


def test_encode_takes_the_likeliest_and_loses_nothing(spark, texts):
    _, model, _ = U.train(texts, size=60)
    scores = dict(zip(model.pieces, model.scores))
    other = spark.createDataFrame([(1, "lower unseenß 漢字"), (2, None), (3, ""), (4, "newest")], "k long, text string")
    for df in (texts, other):
        for r in U.encode(df, model, ["k", "text"]).select("*", U.decode("pieces").alias("back")).collect():
            assert r.back == " ".join((r.text or "").split())
            at = 0
            for w in (r.text or "").split():
                own = []
                while "".join(own) != MARK + w:
                    own.append(r.pieces[at])
                    at += 1
                if all(p in scores for p in own):
                    assert sum(scores[p] for p in own) == pytest.approx(max(sum(scores[p] for p in s) for s in segmentations(MARK + w, scores)))
            assert at == len(r.pieces)


def test_empty_corpus(spark):
    vocab, model, said = U.train(spark.createDataFrame([(None,), ("",)], "text string"), size=10)
    assert [r.piece for r in vocab.sort("id").collect()] == ["</s>", "<unk>"] and model.pieces == said == []


def test_digamma():
    assert U.digamma(1) == pytest.approx(-0.5772156649015329) and U.digamma(0.5) == pytest.approx(-1.9635100260214235)
    assert U.digamma(100.5) == pytest.approx(math.log(100.5) - 1 / 201 - 1 / (12 * 100.5 ** 2), abs=1e-9)
