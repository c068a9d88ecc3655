"""Affix dictionaries against forms listed from the rules."""

import pytest

from corpusflow.operators import affixes as A
from corpusflow.operators import spelling as S

RULES = """
# comment
SET UTF-8
FLAG long
PFX Un Y 1
PFX Un   0 un .
PFX Di N 1
PFX Di   0 dis [^d]
SFX Ss Y 4
SFX Ss   0 s [aeiou]y
SFX Ss   0 s [^sxy]
SFX Ss   0 es [sx]
SFX Ss   y ies [^aeiou]y
SFX Er Y 1
SFX Er   0 er/Ss .
COMPOUNDFLAG Cc
COMPOUNDMIN 2
FORBIDDENWORD Xx
NEEDAFFIX Na
"""
DIC = ["9", "box/SsCc", "play/SsUnErDi", "fly/Ss\tpo:verb", "do/CcUn", "drop/Di", "Paris", "hat/Cc", "odd/Xx", "stemm/SsNa", "and\\/or", "a.b/Ss", "é/Ss"]


@pytest.fixture(scope="module")
def book(spark):
    rules = A.parse_rules(RULES.splitlines())
    lines = spark.createDataFrame([(x,) for x in DIC], "value string")
    plain = spark.createDataFrame([("cy", "gair", [])], "lang string, stem string, flags array<string>")
    return A.AffixDictionary(A.parse_stems(lines, "en", rules).unionByName(plain), {"en": rules})


GOOD = ["box", "boxes", "play", "plays", "player", "unplay", "unplays", "unplayer", "display", "fly", "flies", "do", "undo", "Paris", "PARIS",
        "Box", "BOXES", "Unplays", "boxhat", "hatboxhat", "dodo", "Hatbox", "stemms", "and/or", "a.b", "a.bs", "és", "hat"]
BAD = ["boxs", "flys", "plaies", "displays", "disdrop", "drops", "paris", "pARIS", "bOX", "odd", "Odd", "stemm", "unfly", "hatplay", "boxhatx", "doe",
       "undoes", "un", "s", "a-b", "axb", "gair", "players"]


def test_words(spark, book):
    toks = spark.createDataFrame([("en", w) for w in [*GOOD, *BAD, *BAD]] + [("cy", "gair"), ("cy", "Gair"), ("cy", "box"), ("xx", "box")], "lang string, word string")
    got = {(r.lang, r.word): r.n for r in S.unknown_words(toks, book).collect()}
    assert got == {("en", w): 2 for w in BAD} | {("cy", "box"): 1, ("xx", "box"): 1}


def test_in_the_spelling_report(spark, book):
    pairs = spark.createDataFrame([("1", "en-cy", "he plays boxes", "gair"), ("2", "en-cy", "flies undo", "gair gwall")],
                                  "id string, langs string, source string, target string")
    bad = S.misspelt_words(pairs, book).collect()
    assert sorted((r.id, r.word) for r in bad) == [("1", "he"), ("2", "gwall")]


def test_files(spark, tmp_path):
    (tmp_path / "x.aff").write_text(RULES)
    (tmp_path / "x.dic").write_text("\n".join(DIC))
    rules = A.read_rules(spark, str(tmp_path / "x.aff"))
    stems = A.read_stems(spark, str(tmp_path / "x.dic"), "en", rules)
    assert {r.stem: r.flags for r in stems.collect()}["play"] == ["Ss", "Un", "Er", "Di"] and stems.count() == len(DIC) - 1
    assert len(rules.suffixes) == 4 and rules.prefixes["un"][0].cross and not rules.prefixes["dis"][0].cross


def test_flag_kinds(spark):
    for kind, text, want in (("num", "1,23", ["1", "23"]), ("UTF-8", "éß", ["é", "ß"]), ("long", "abcd", ["ab", "cd"])):
        rules = A.parse_rules([f"FLAG {kind}"])
        assert A.parse_stems(spark.createDataFrame([(f"w/{text}",), ("v",)], "value string"), "x", rules).collect() == [("x", "w", want), ("x", "v", [])]


def test_no_words_and_no_stems(spark, book):
    none = spark.createDataFrame([], "lang string, word string")
    assert book.unknown(none).count() == 0
    empty = A.AffixDictionary(spark.createDataFrame([], "lang string, stem string, flags array<string>"), book.rules)
    assert [tuple(r) for r in empty.unknown(spark.createDataFrame([("en", "x")], "lang string, word string")).collect()] == [("en", "x", 1)]


def test_compounds_meet_the_stems_by_few_parts(spark):
    rules = A.parse_rules(["COMPOUNDFLAG C"])
    stems = ["hat", "box", "lamp", "é\U0001f600x"]
    book = A.AffixDictionary(spark.createDataFrame([("en", w, ["C"]) for w in stems], "lang string, stem string, flags array<string>"), {"en": rules})
    bits = A._part_bits(book.stems)
    assert sum(b.bit_count() for b in bits) == len(stems) and len(bits) == A.FILTER_BITS // 8
    assert sorted(A._spans("en", "hatboxé\U0001f600x", bits, 4)) == [(0, 3), (3, 6), (6, 9)]
    # no way from start to end, one part only, another language
    assert A._spans("en", "hatboxq" * 9, bits, 4) == A._spans("en", "hat", bits, 4) == A._spans("cy", "hatbox", bits, 4) == []
    # a filter that knows everything changes no result
    words = spark.createDataFrame([("en", w) for w in ("hatbox", "boxé\U0001f600xhat", "hatboxq", "hat", "Lamphat", "LAMPBOX")], "lang string, word string")
    found = {r.word for r in book.compounds(words).collect()}
    assert found == {"hatbox", "boxé\U0001f600xhat", "Lamphat", "LAMPBOX"}
