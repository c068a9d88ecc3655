from pyspark.sql import functions as F

from corpusflow.operators import borders as B


def corpus(spark):
    rows = [(i, "en", f"We saw cf. item {w} there. There they left the {w}. He met Dr. Jones of the town!")
            for i, w in enumerate(["house", "tree", "river", "road", "hill", "lake"] * 5)]
    rows += [(100, "cy", "Gwelwch h.y. yma. Dyna ni."), (101, None, "No name. None."), (102, "en", None), (103, "en", "")]
    return spark.createDataFrame(rows, "id int, lang string, text string")


def test_learnt_words(spark):
    scores = B.abbreviation_scores(corpus(spark))
    found = {(r.lang, r.word) for r in B.abbreviations(scores).collect()}
    assert ("en", "cf") in found and ("en", "dr") in found
    assert ("en", "the") not in found and ("en", "there") not in found and ("en", "house") not in found
    counts = {(r.lang, r.word): (r.n_stop, r.n_free) for r in scores.collect()}
    assert counts["en", "cf"] == (30, 0) and counts["en", "the"] == (0, 60) and counts["cy", "h.y"] == (1, 0)
    assert (None, "name") in counts


def test_sentences_are_not_cut_behind_them(spark):
    df = corpus(spark)
    short = B.abbreviations(B.abbreviation_scores(df))
    rows = B.trained_sentence_rows(df, ["id"], short).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.id, r.pos)):
        got.setdefault(r.id, []).append(r.sentence)
    assert got[0] == ["We saw cf. item house there", "There they left the house", "He met Dr. Jones of the town!"]
    # too few to be learnt, another language, no language, no text
    assert got[100] == ["Gwelwch h.y", "yma", "Dyna ni"] and got[101] == ["No name", "None"]
    assert 102 not in got and 103 not in got


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "en", "no stop here"), (2, "fr", "Fin. Fin.")], "id int, lang string, text string")
    scores = B.abbreviation_scores(df)
    assert {r.score for r in scores.collect()} == {0.0}
    empty = df.where("id < 0")
    assert B.abbreviation_scores(empty).count() == 0
    assert B.trained_sentence_rows(df, ["id"], B.abbreviations(scores)).where(F.col("id") == 2).count() == 2


def test_whitespace_of_tokens_is_that_of_the_rules():
    import sys
    from corpusflow.functions import rules as R
    assert {c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()} == set(R.PY_SPACE_CHARS)


def test_tokens_are_counted_before_they_are_rows(spark, monkeypatch):
    """A task passes on a row for each different token, not for each token; also when it does so early."""
    df = spark.createDataFrame([(None, "a\u2003b. a"), ("en", None), ("en", "")] + [("en", "one two. one\u00a0 \n two.")] * 500, "lang string, text string").coalesce(1)
    want = {("en", "one"): 1000, ("en", "two."): 1000, (None, "a"): 2, (None, "b."): 1}
    rows = B.token_counts(df).collect()
    assert {(r.lang, r.t): r.n for r in rows} == want and len(rows) == 4
    monkeypatch.setattr(B, "MOST_TOKENS", 1)
    scores = {(r.lang, r.word): (r.n_stop, r.n_free) for r in B.abbreviation_scores(df).collect()}
    assert scores == {("en", "one"): (0, 1000), ("en", "two"): (1000, 0), (None, "a"): (0, 2), (None, "b"): (1, 0)}


def test_few_abbreviations_are_sent_and_many_joined(spark, monkeypatch):
    """The pieces are shuffled by the text's key only; the same sentences come of both ways."""
    df = corpus(spark)
    short = B.abbreviations(B.abbreviation_scores(df))
    sent = B.trained_sentence_rows(df, ["id"], short)
    plan = sent._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    monkeypatch.setattr(B, "MOST_SENT", 0)
    joined = B.trained_sentence_rows(df, ["id"], short)
    assert "strategy=broadcast" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, sent.collect())) == sorted(map(tuple, joined.collect()))
