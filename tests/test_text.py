"""Text functions and cleaning on hand-written rows (quirks from SURVEY section 9)."""

from pyspark.sql import functions as F

from corpusflow.functions import text as T
from corpusflow.operators import filters


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first()["y"]


def test_fix_whitespace_order(spark):
    assert one(spark, T.fix_whitespace, "a\r\nb\nc\td") == "a b c    d"


def test_strip_control_removes_format_chars(spark):
    # zero-width space, soft hyphen (Cf) and a C0 control go; NBSP (Zs) stays
    assert one(spark, T.strip_control, "a​b­c\u0007d e") == "abcd e"


def test_normalize_english(spark):
    assert one(spark, lambda c: T.normalize(c, "en"), "  “Hello” (world) ,  it’s 5 % …  ") == \
        "Hello (world), it's 5% ..."


def test_normalize_keeps_welsh_letters_and_drops_quotes(spark):
    assert one(spark, lambda c: T.normalize(c, "cy"), 'Mae\'r "ŵyn" yn â #hapus') == "Mae'r ŵyn yn â hapus"


def test_normalize_nbsp_number_rules(spark):
    assert one(spark, lambda c: T.normalize(c, "fr"), "1 000") == "1,000"
    assert one(spark, lambda c: T.normalize(c, "en"), "1 000") == "1.000"


def test_normalize_no_language_applies_no_keep_list(spark):
    assert one(spark, lambda c: T.normalize(c, None), "a#b") == "a#b"


def test_python_strip_trims_unicode_space(spark):
    assert one(spark, T.py_strip, "　 x  ") == "x"


def test_lang_code(spark):
    assert one(spark, T.lang_code, "en-GB") == "en"
    assert one(spark, T.lang_code, "CY") == "cy"


def test_wordfast_tags(spark):
    assert one(spark, T.strip_wf_tags, "a&tA;b&tZ;c&ta;") == "abc&ta;"


def test_alpha_tokens(spark):
    assert one(spark, T.alpha_tokens, "Don't stop co-op abc123 Ŵyn, yes.") == ["Don", "t", "stop", "Ŵyn", "yes"]
    text = "don't go, l'homme mae'r co-op 'quoted' rock'n'roll x'5"
    words = lambda lang: one(spark, lambda c: T.alpha_tokens(c, lang), text)
    assert words("en") == ["don", "go", "l", "mae", "quoted", "rock", "x"]
    assert words("fr") == ["t", "go", "homme", "r", "quoted", "roll", "x"]
    assert words("cy") == ["don", "t", "go", "l", "homme", "mae", "r", "quoted", "rock", "n", "roll", "x"]


def test_translation_id_is_stable(spark):
    df = spark.createDataFrame([("Health", "a", "b")], "c string, s string, t string")
    a = df.select(T.translation_id("c", "s", "t")).first()[0]
    b = df.select(T.translation_id("c", "s", "t")).first()[0]
    assert a == b and a > 0


def _units(spark, rows):
    return spark.createDataFrame(rows, "source_lang string, source string, target_lang string, target string, classifier string")


def test_clean_reasons(spark):
    rows = [("en", "Hello there.", "cy", "Helo yna.", "Health"),          # kept
            ("cy", "Bore da", "en", "Good morning", "Health"),            # swapped, kept
            ("en", "Hi", "fr", "Salut", "Health"),                        # not in pair
            ("en", "Hi", "en", "Hello", "Health"),                        # same language
            ("en", None, "cy", "x", "Health"),                            # null text
            ("en", "--. menu", "cy", "dewislen", "Health"),               # leader chars
            ("en", "-.-x", "cy", "y", "Health"),                          # mixed leader
            ("en", " cy ", "cy", "Helo", "Health"),                       # suspicious
            ("en", "NA", "cy", "null", "Health")]                         # missing-value words kept
    out = filters.clean(_units(spark, rows), ("en", "cy")).collect()
    reasons = [r["reject_reason"] for r in out]
    assert reasons.count(None) == 3
    assert sorted(r for r in reasons if r) == sorted([
        filters.NOT_IN_PAIR, filters.SAME_LANGUAGE, filters.NULL_TEXT, filters.LEADER_CHARS,
        filters.LEADER_CHARS, filters.SUSPICIOUS])
    swapped = [r for r in out if r["source"] == "Good morning"][0]
    assert swapped["target"] == "Bore da" and swapped["langs"] == "en-cy"
    na = [r for r in out if r["source"] == "NA"][0]
    assert na["reject_reason"] is None and na["target"] == "null"


def test_spelling_gate(spark):
    from corpusflow.operators import spelling
    lex = spark.createDataFrame([("en", "hello"), ("en", "world"), ("cy", "helo")], "lang string, word string")
    pairs = spark.createDataFrame([(1, "Hello WORLD", "Helo", "en-cy"), (2, "Hello wrold", "Helo", "en-cy"),
                                   (3, "hElLo", "Helo", "en-cy")], "id long, source string, target string, langs string")
    kept = sorted(r["id"] for r in spelling.spelling_gate(pairs, lex).collect())
    assert kept == [1]
    sents = {r["translation_id"]: r["words"] for r in
             spelling.misspelt_sentences(spelling.misspelt_words(pairs, lex)).collect()}
    assert sents == {2: "wrold", 3: "hElLo"}


def test_spelling_short_circuit(spark):
    from corpusflow.operators import spelling
    lex = spark.createDataFrame([("en", "hello"), ("cy", "helo")], "lang string, word string")
    pairs = spark.createDataFrame([(1, "hello wrold", "helo xx", "en-cy"), (2, "hello", "helo yy", "en-cy")],
                                  "id long, source string, target string, langs string")
    full = sorted(r["word"] for r in spelling.misspelt_words(pairs, lex).collect())
    short = sorted(r["word"] for r in spelling.misspelt_words(pairs, lex, short_circuit=True).collect())
    assert full == ["wrold", "xx", "yy"] and short == ["wrold", "yy"]


def test_sentences_of_a_text_with_any_character(spark):
    from corpusflow.functions import text as T
    from pyspark.sql import functions as F
    rows = [("One. Two!?  Three\n4", ["One.", "Two!?", "Three\n4"]), ("a ␞ b. c␞", ["a ␞ b.", "c␞"]), (". . x", [".", ".", "x"]), ("", []), ("a.  ", ["a."])]
    got = spark.createDataFrame([(t,) for t, _ in rows], "t string").select(T.split_sentences(F.col("t")).alias("s")).collect()
    assert [r.s for r in got] == [w for _, w in rows]


def test_every_request_is_answered(spark):
    from corpusflow.operators import requests as R
    df = spark.createDataFrame([(1, "One. Two."), (2, ""), (3, None), (4, " \n"), (5, "a.\nb. c")], "k long, text string")
    got = {r.k: r.text for r in R.reassemble(R.sentence_rows(df, ["k"]), df, ["k"]).collect()}
    assert set(got) == {1, 2, 3, 4, 5} and (got[2], got[3], got[4]) == ("", None, "") and got[1] == "One  Two"


def test_pairs_are_made_once_for_words_and_tokens(spark):
    from pyspark.sql import functions as F

    from corpusflow.operators import spelling
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(x):
        made.add(1)
        return x

    raw = spark.createDataFrame([(i, "en-en", "good bad", "good") for i in range(8)], "id long, langs string, source string, target string")
    pairs = raw.withColumn("source", text("source"))
    lexicon = spark.createDataFrame([("en", "good")], "lang string, word string")
    bad = spelling.misspelt_words(pairs, lexicon)
    assert sorted(tuple(r) for r in bad.collect()) == [("en", "bad", i) for i in range(8)] and made.value == 8
