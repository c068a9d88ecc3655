"""Metric values on hand-computed examples."""

import math

import pytest

from corpusflow.operators import metrics as M


def _df(spark, pairs):
    return spark.createDataFrame([(i, r, h) for i, (r, h) in enumerate(pairs)], "seg long, ref string, hyp string")


def test_bleu_identical_is_100(spark):
    df = _df(spark, [("the cat sat on the mat .", "the cat sat on the mat .")])
    assert M.bleu(df).first()["bleu"] == pytest.approx(100.0)


def test_bleu_hand_computed(spark):
    # hyp 4 tokens, ref 6: p1 = 4/4, p2 = 3/3, p3 = 2/2, p4 = 1/1, BP = exp(1 - 6/4)
    df = _df(spark, [("a b c d e f", "a b c d")])
    assert M.bleu(df).first()["bleu"] == pytest.approx(100 * math.exp(1 - 6 / 4))


def test_bleu_exp_smoothing(spark):
    # hyp "a x b y" vs ref "a b c d": 1-grams 2/4, no higher matches
    df = _df(spark, [("a b c d", "a x b y")])
    p = [50.0, 100 / (2 * 3), 100 / (4 * 2), 100 / (8 * 1)]
    expected = math.exp(sum(math.log(x) for x in p) / 4)
    assert M.bleu(df).first()["bleu"] == pytest.approx(expected)


def test_chrf_identical_is_100(spark):
    df = _df(spark, [("hello world", "hello world")])
    assert M.chrf(df).first()["chrf"] == pytest.approx(100.0)


def test_wer_and_edit_rate(spark):
    df = _df(spark, [("a b c d", "a x c"), ("e f", "E f")])
    # distances: 2 (sub b->x, del d) and 1 (case) over 6 reference words
    assert M.wer(df).first()["wer"] == pytest.approx(3 / 6)
    # edit rate lower-cases: 2 / 6 * 100
    assert M.edit_rate(df).first()["edit_rate"] == pytest.approx(100 * 2 / 6)


def test_mer_wil(spark):
    df = _df(spark, [("a b c d", "a x c")])
    r = M.mer_wil(df).first()
    # E = 2, H = 2, N = 4, M = 3
    assert r["mer"] == pytest.approx(2 / 4)
    assert r["wil"] == pytest.approx(1 - (2 / 4) * (2 / 3))


def test_chrf_counts_no_hypothesis_grams_where_the_reference_has_none(spark):
    # reference of 2 characters: orders 1 and 2 only; p1 = 2/8, p2 = 1/7, r1 = r2 = 1
    df = _df(spark, [("ab", "abcdefgh")])
    p, r = (2 / 8 + 1 / 7) / 2, 1.0
    assert M.chrf(df).first()["chrf"] == pytest.approx(100 * 5 * p * r / (4 * p + r))


def test_characters_beyond_the_first_plane(spark):
    assert M.chrf(_df(spark, [("😀ab", "😀ab")])).first()["chrf"] == pytest.approx(100.0)
    m, h, r = M.gram_statistics(*M._ids("😀ab", "😀ab"), 2)[1]
    assert (m, h, r) == (2, 2, 2)


def test_empty_sides_do_not_fail(spark):
    df = _df(spark, [("", "a b"), (None, "c"), ("", "")])
    assert M.wer(df).first()["wer"] is None
    assert {r["metric"]: r["score"] for r in M.score(_df(spark, [("a b", "")])).collect()}["WIL"] is None
    assert {r["metric"] for r in M.score(df).collect()} == {"BLEU", "CHRF", "TER", "WER", "MER", "WIL"}


def test_scores_per_key(spark):
    rows = [("x", "a b c d", "a b c d"), ("y", "a b c d", "a b c e")]
    df = spark.createDataFrame(rows, "split_n string, ref string, hyp string")
    got = {(r["split_n"], r["metric"]): r["score"] for r in M.score(df, ["split_n"]).collect()}
    assert got["x", "WER"] == 0 and got["y", "WER"] == pytest.approx(0.25) and got["x", "BLEU"] == pytest.approx(100.0)


def test_word_distance_against_the_plain_recurrence():
    import random
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 90))] for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        assert M.word_distance(a, b) == row[-1]


def test_shifts_of_the_published_example():
    # one block moves, two words are replaced, one is missing (Snover et al. 2006)
    ref = "SAUDI ARABIA denied THIS WEEK information published in the AMERICAN new york times".lower().split()
    hyp = "THIS WEEK THE SAUDIS denied information published in the new york times".lower().split()
    assert M.shifted_edits(ref, hyp) == 4 and len(ref) == 13


def _listed_rates(ref, hyp):
    """Fewest edits over all orders of block moves (each one edit), by breadth-first search."""
    best, seen, layer, moves = M.word_distance(ref, hyp), {tuple(hyp)}, [tuple(hyp)], 0
    while moves + 1 < best:
        moves += 1
        new = set()
        for w in layer:
            for i in range(len(w)):
                for k in range(1, len(w) - i + 1):
                    rest = w[:i] + w[i + k:]
                    new |= {rest[:t] + w[i:i + k] + rest[t:] for t in range(len(rest) + 1)}
        layer = list(new - seen)
        seen |= new
        best = min([best, *(moves + M.word_distance(ref, list(w)) for w in layer)])
    return best


def test_shifts_against_all_moves():
    import random
    rng = random.Random(11)
    same = 0
    for _ in range(150):
        ref = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 6))]
        hyp = list(ref)
        for _ in range(rng.randint(0, 2)):
            k = rng.randint(0, len(hyp))
            hyp = hyp[k:] + hyp[:k]
            if hyp and rng.random() < 0.5:
                hyp[rng.randrange(len(hyp))] = rng.choice("abxyz")
        got, least, plain = M.shifted_edits(ref, hyp), _listed_rates(ref, hyp), M.word_distance(ref, hyp)
        assert least <= got <= plain
        same += got == least
    assert same > 130  # the search is greedy


def test_alignment_costs_the_distance():
    import random

    import numpy as np
    rng = random.Random(4)
    for _ in range(200):
        ref, hyp = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in "ab")
        at, wrong_ref, wrong_hyp = M._alignment(np.array(ref, int), np.array(hyp, int))
        assert len(at) == len(ref) and at == sorted(at)
        assert max(wrong_ref[-1], wrong_hyp[-1]) <= M.word_distance(ref, hyp) <= wrong_ref[-1] + wrong_hyp[-1]
        for j, i in enumerate(at):
            if wrong_ref[j + 1] == wrong_ref[j]:
                assert ref[j] == hyp[i]


def test_move_lands_where_it_should():
    w = list("abcdef")
    assert "".join(M._moved(w, 1, 2, 0)) == "bcadef" and "".join(M._moved(w, 1, 2, 5)) == "adebcf"
    assert "".join(M._moved(w, 1, 2, 2)) == "adbcef" and "".join(M._moved(w, 0, 6, 3)) == "abcdef"


def test_hits_beyond_a_million_words():
    n = (1 << 20) + 3
    # (cost, hits) must not run into one another
    assert M._KEY > n and (2 * M._KEY - n) // M._KEY == 1
    w = [str(i) for i in range(700)]
    assert M.alignment_hits(w, w[1:]) == 699


def test_long_segments_with_moves_end():
    import random
    import time
    rng = random.Random(1)
    ref = [f"w{rng.randint(0, 400)}" for _ in range(1500)]
    hyp = ref[700:] + ref[:700]
    t = time.time()
    assert M.shifted_edits(ref, hyp) <= M.word_distance(ref, hyp)
    assert time.time() - t < 60


def test_batches_count_like_single_segments():
    import random

    import numpy as np
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(6)] + ["é", "\U0001f600"]
    segments = [[rnd.choices(words[:rnd.randrange(1, 9)], k=rnd.choice([0, 1, 2, 5, 20, 60])) for _ in range(2)] for _ in range(400)]
    for i in range(100):  # some alike
        r = rnd.choices(words, k=30)
        segments.append([r, [w for j, w in enumerate(r) if j % rnd.randrange(3, 9)]])
    segments.append([rnd.choices(words, k=700), rnd.choices(words, k=650)])
    refs, hyps = [r for r, _ in segments], [h for _, h in segments]
    assert M.hits_of(refs, hyps) == [M.alignment_hits(r, h) for r, h in segments]
    for r, h, order in ((refs, hyps, 4), (["".join(x) for x in refs], ["".join(x) for x in hyps], 6)):
        want = [M.gram_statistics(*M._ids(b, a), order) for a, b in zip(r, h)]
        assert M.grams_of(h, r, order).tolist() == [[list(x) for x in row] for row in want]
    many = [[f"x{rnd.randrange(10**5)}" for _ in range(3000)] * 2 for _ in range(30)]
    want = [M.gram_statistics(*M._ids(a, b), 4) for a, b in zip(many, reversed(many))]
    assert np.array_equal(M.grams_of(many, many[::-1], 4), np.array(want)) and M.grams_of([], [], 4).shape == (0, 4, 3)


def test_bleu_tokens_in_the_task(spark):
    import random

    from pyspark.sql import functions as F

    from corpusflow.functions import rules as R
    rnd = random.Random(9)
    bits = ["a", "B", "1", "23", ".", ",", "-", "\n", "-\n", " ", "  ", "<skipped>", "&quot;", "&amp;", "&amp;lt;", "&lt;", "'", "é", "\U0001f600", "\x1c", "\x85", "　", *map(chr, range(33, 127)), *R.PY_SPACE_CHARS]
    texts = ["".join(rnd.choices(bits, k=rnd.randrange(60))) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    got = {r.x: list(r.w) for r in df.select("x", M.tokenize_13a(F.col("x")).alias("w")).collect()}
    assert {x: M.words_13a(x) for x in texts} == got
    plan = M.bleu(df.select(F.col("x").alias("ref"), F.col("x").alias("hyp")))._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan


def test_ter_looks_for_no_move_that_wins_nothing(monkeypatch):
    def never(*_):
        raise AssertionError("aligned")

    monkeypatch.setattr(M, "_alignment", never)
    ref = [f"w{i}" for i in range(40)]
    assert M.shifted_edits(ref, ["x", *ref[1:]]) == 1
    assert M.shifted_edits(ref, [*ref[:20], "x", *ref[21:], "y"]) == 2


def test_a_word_is_taken_apart_once(monkeypatch):
    import random
    rnd = random.Random(3)
    bits = ["a", "B", "7", "1.", ".", ",", "-", "-\n", "\n", " ", "<skipped>", "<skip", "ped>", "&amp;lt;", "&quot;", "é", "\x85", "　", "don't", "x-1"]
    texts = ["".join(rnd.choices(bits, k=rnd.randrange(40))) for _ in range(500)]
    assert M.tokens_13a(texts) == [M.words_13a(x) for x in texts]
    seen, parts = [], M._parts_13a
    monkeypatch.setattr(M, "_parts_13a", lambda x: seen.append(x) or parts(x))
    assert M.tokens_13a(["the end. the end.", "the, end."] * 50) == [["the", "end", ".", "the", "end", "."], ["the", ",", "end", "."]] * 50
    assert sorted(seen) == ["end.", "the,"]


def test_grams_of_wide_alphabets_count_like_single_segments():
    import random

    import numpy as np
    rnd = random.Random(8)
    # six of these characters do not fit one number
    texts = ["".join(chr(rnd.randrange(0x4e00, 0x4e00 + 9000)) for _ in range(400)) for _ in range(80)] + ["", "\x00", "ab"]
    other = [x[:150] + x[151:] + x[:20] for x in texts]
    want = [M.gram_statistics(*M._ids(a, b), 6) for a, b in zip(other, texts)]
    assert np.array_equal(M.grams_of(other, texts, 6), np.array(want))


def test_alignment_against_the_plain_table():
    import random
    rng = random.Random(6)
    for _ in range(300):
        ref, hyp = ([rng.choice("abc") for _ in range(rng.randint(0, 14))] for _ in "ab")
        n, m = len(ref), len(hyp)
        cost = [[i + j for j in range(n + 1)] for i in range(m + 1)]
        for i in range(1, m + 1):
            for j in range(1, n + 1):
                cost[i][j] = min(cost[i - 1][j - 1] + (ref[j - 1] != hyp[i - 1]), cost[i - 1][j] + 1, cost[i][j - 1] + 1)
        before, bad_ref, bad_hyp, i, j = [-1] * n, [0] * n, [0] * m, m, n
        while i or j:
            if i and j and cost[i][j] == cost[i - 1][j - 1] + (ref[j - 1] != hyp[i - 1]):
                bad_ref[j - 1] = bad_hyp[i - 1] = int(ref[j - 1] != hyp[i - 1])
                i, j = i - 1, j - 1
                before[j] = i
            elif i and (not j or cost[i][j] == cost[i - 1][j] + 1):
                i -= 1
                bad_hyp[i] = 1
            else:
                j -= 1
                bad_ref[j], before[j] = 1, i - 1
        got, wrong_ref, wrong_hyp = M._alignment(ref, hyp)
        assert got == before
        assert list(wrong_ref) == [sum(bad_ref[:k]) for k in range(n + 1)] and list(wrong_hyp) == [sum(bad_hyp[:k]) for k in range(m + 1)]
        assert M.word_distance(ref, hyp, M._places(ref)) == cost[m][n]


def test_texts_are_split_in_the_task(spark):
    plan = M.score(_df(spark, [("a b", "a c")]))._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan and "filter(" not in plan


def test_odd_rows_count_as_before(spark):
    rows = [(None, "a b  c\t", "a　b c"), (None, "a b  c\t", "a　b c"), (None, None, "x y"), (1, "A.Σ ΣΑΣ", "a.ς σας"),
            (1, "", ""), (1, " \x85 ", None), (1, "d e f g h", "g h d e f"), (2, None, None)]
    df = spark.createDataFrame(rows, "k long, ref string, hyp string")
    sums = {r.k: r.asDict() for r in M.segment_sums(df, ["k"], list(M._FIELDS)).collect()}
    words = {k: [sums[k][c] for c in ("dist", "ref_words", "hyp_words", "low_dist", "low_ref_words", "hits")] for k in sums}
    assert words == {None: [2, 6, 8, 2, 6, 6], 1: [6, 7, 7, 1, 7, 3], 2: [0] * 6}
    assert [sums[None][f"bleu_{c}1"] for c in ("match", "hyp", "ref")] == [6, 8, 6]
    assert [sums[1][f"chrf_{c}6"] for c in ("match", "hyp", "ref")] == [0, 1, 1]


def test_one_table_gives_distances_and_hits():
    import random
    rng = random.Random(12)
    segments = [[[rng.choice("abcd"[:rng.randint(1, 4)]) for _ in range(rng.choice([0, 1, 3, 9, 30]))] for _ in "ab"] for _ in range(300)]
    segments.append([[f"w{rng.randrange(40)}" for _ in range(k)] for k in (600, 560)])  # by itself
    want = []
    for r, h in segments:
        row = [(j, 0) for j in range(len(h) + 1)]  # (edits, -hits)
        for i, x in enumerate(r, 1):
            prev, row[0] = row[0], (i, 0)
            for j, y in enumerate(h, 1):
                pair = (prev[0], prev[1] - 1) if x == y else (prev[0] + 1, prev[1])
                prev, row[j] = row[j], min(pair, (row[j][0] + 1, row[j][1]), (row[j - 1][0] + 1, row[j - 1][1]))
        want.append((row[-1][0], -row[-1][1]))
    assert [tuple(x) for x in M.edits_of(*zip(*segments)).tolist()] == want
    assert [M.alignment(r, h) for r, h in segments] == want


def test_mer_wil_fills_no_second_table(monkeypatch):
    import pandas as pd

    def never(*_):
        raise AssertionError("a table of its own")

    monkeypatch.setattr(M, "word_distance", never)
    stats, names = M._statistics(["edits", "hits"])
    got = stats.func(pd.Series(["a x c", "", " b\x85a "]), pd.Series(["a b c d", "a", ""]))
    assert got[names].to_numpy().tolist() == [[2, 4, 3, 2], [1, 1, 0, 0], [2, 0, 2, 0]]
    assert stats.func(pd.Series([], dtype=str), pd.Series([], dtype=str)).shape == (0, 4)
