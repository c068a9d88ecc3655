"""Text column functions (TXT1-TXT16).

All are built-in Spark expressions, so they run inside whole-stage codegen
and need no Python worker. ``lang`` may be a Python string (rules are chosen
while the plan is built) or a Column (rules are chosen per row by CASE).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions import rules as R


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _apply(c: Column, rule_list) -> Column:
    """Apply ordered rules; plain-string rules become ``replace`` (far less
    generated code than a regex, which keeps long chains inside codegen)."""
    def step(acc, rule):
        pattern, repl = rule
        lit = R.literal_of(pattern)
        if lit is not None:
            return F.replace(acc, F.lit(lit), F.lit(repl))
        return F.regexp_replace(acc, pattern, R.java_repl(repl))
    return reduce(step, rule_list, c)


def normalize_columns(df, specs):
    """TXT5 on DataFrame columns, staged for speed: ``specs`` = [(column, lang)].

    Same result as :func:`normalize` with a literal language. Each regex rule
    is applied only to texts that contain its literal trigger; those guarded
    steps reference the column three times, so Catalyst keeps them as
    separate projections (no expression copies) fused in one codegen stage.
    """
    for name, lang in specs:
        c = F.col(name)
        df = df.withColumn(name, strip_control(fix_whitespace(c)))
        per_row = not (lang is None or isinstance(lang, str))
        for pattern, repl in (R.PUNCT_COMMON if per_row else R.punct_rules(lang)):
            df = df.withColumn(name, _guarded(F.col(name), pattern, repl))
        if per_row:
            # language-specific tail, pattern chosen per row, guarded by its trigger
            x = F.col(name)
            tail = normalize_punct_tail(x, _col(lang))
            df = df.withColumn(name, F.when(x.contains('"') | x.contains("\xa0"), tail).otherwise(x))
        df = df.withColumn(name, py_strip(F.col(name)))
        df = df.withColumn(name, py_strip(keep_lang_chars(F.col(name), lang)))
    return df


def _guarded(c: Column, pattern: str, repl: str) -> Column:
    lit = R.literal_of(pattern)
    if lit is not None:
        return F.replace(c, F.lit(lit), F.lit(repl))
    out = F.regexp_replace(c, pattern, R.java_repl(repl))
    trigger = R.GUARDS.get(pattern)
    if trigger is None:
        return out
    return F.when(c.contains(trigger), out).otherwise(c)


def fix_whitespace(c) -> Column:
    """TXT1: CRLF -> LF, LF -> space, tab -> four spaces (in that order)."""
    c = _col(c)
    for old, new in R.RAW_REPLACEMENTS:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def strip_control(c) -> Column:
    """TXT2: drop every character of Unicode category C*."""
    return F.regexp_replace(_col(c), "\\p{C}", "")


def py_strip(c) -> Column:
    """Python ``str.strip()``: trims every Unicode whitespace, not only U+0020."""
    return F.trim(_col(c), F.lit(R.PY_SPACE_CHARS))


def normalize_punct(c, lang=None) -> Column:
    """TXT3: Moses punctuation normalisation; ``lang=None`` = no language rules."""
    c = _col(c)
    if lang is None or isinstance(lang, str):
        return py_strip(_apply(c, R.punct_rules(lang)))
    # Per-row language: the rule *pattern* is chosen per row instead of
    # copying the whole chain into every CASE branch, so the expression stays
    # one chain (small enough for codegen). Spark recompiles a pattern only
    # when it changes from the previous row.
    return py_strip(normalize_punct_tail(_apply(c, R.PUNCT_COMMON), _col(lang)))


def normalize_punct_tail(x: Column, lang: Column) -> Column:
    """Language-dependent Moses rules (quote/comma, number NBSP), per row."""
    en = lang.isin(*R.QUOTE_COMMA_LANGS_EN)
    eu = lang.isin(*R.QUOTE_COMMA_LANGS_EU)
    (p_en, r_en), = R.PUNCT_EN_QUOTE_COMMA
    (p_eu1, r_eu1), (p_eu2, r_eu2) = R.PUNCT_DE_ES_FR_QUOTE_COMMA
    x = F.regexp_replace(x, F.when(en, F.lit(p_en)).when(eu, F.lit(p_eu1)).otherwise(F.lit(NEVER)),
                         F.when(en, F.lit(R.java_repl(r_en))).when(eu, F.lit(R.java_repl(r_eu1))).otherwise(F.lit("")))
    x = F.regexp_replace(x, F.when(eu, F.lit(p_eu2)).otherwise(F.lit(NEVER)),
                         F.when(eu, F.lit(R.java_repl(r_eu2))).otherwise(F.lit("")))
    (p_num, r_comma), = R.PUNCT_NUMBER_COMMA
    (_, r_dot), = R.PUNCT_NUMBER_DOT
    x = F.regexp_replace(x, F.lit(p_num),
                         F.when(lang.isin(*R.NUMBER_COMMA_LANGS), F.lit(R.java_repl(r_comma)))
                         .otherwise(F.lit(R.java_repl(r_dot))))
    return x


NEVER = "(?!)"  # a pattern that matches nowhere


def keep_lang_chars(c, lang) -> Column:
    """TXT4: remove characters outside the language keep-list (if it has one)."""
    c = _col(c)
    if lang is None or isinstance(lang, str):
        pat = R.keep_pattern(lang) if lang else None
        if not pat:
            return c
        # translate() deletes the allowed characters natively (no UTF-16
        # copy); only texts with something left over need the regex
        clean = F.length(F.translate(c, R.keep_chars(lang), "")) == 0
        return F.when(clean, c).otherwise(F.regexp_replace(c, pat, ""))
    lang = _col(lang)
    pat = None
    for code in R.KEEP_EXTRA:
        p = F.lit(R.keep_pattern(code))
        pat = F.when(lang == code, p) if pat is None else pat.when(lang == code, p)
    return F.regexp_replace(c, pat.otherwise(F.lit(NEVER)), F.lit(""))


def normalize(c, lang=None) -> Column:
    """TXT5: whitespace fix -> control strip -> punctuation -> keep-list -> strip."""
    x = strip_control(fix_whitespace(c))
    x = normalize_punct(x, lang)
    x = keep_lang_chars(x, lang)
    return py_strip(x)


def lang_code(c) -> Column:
    """TXT6: ``en-GB`` -> ``en``."""
    return F.lower(F.split(_col(c), "-").getItem(0))


def strip_wf_tags(c) -> Column:
    """TXT7: remove Wordfast ``&tX;`` tags."""
    return F.regexp_replace(_col(c), R.WORDFAST_TAG, "")


# --- FIXED VALUES: languages with an apostrophe rule of their own -------------
APOSTROPHE_LEFT = ("en",)         # don't -> don + 't
APOSTROPHE_RIGHT = ("fr", "it")   # l'homme -> l' + homme

_RUN = "(?<![\\p{L}\\p{N}\\-])%s\\p{L}+(?![\\p{L}\\p{N}\\-])%s"
ALPHA_RUN = _RUN % ("", "")
ALPHA_RUN_LEFT = _RUN % ("(?<![\\p{L}\\p{N}]')", "")
ALPHA_RUN_RIGHT = _RUN % ("", "(?!'\\p{L})")


def alpha_tokens(c, lang=None) -> Column:
    """TXT8: the tokens of a Moses tokeniser that are letters alone.

    Text is cut at every character that is not a letter, digit or hyphen, so
    ``co-op`` and ``abc123`` are no words. An apostrophe between letters stays
    with what follows in English (``don't`` gives ``don``), with what precedes
    in French and Italian (``l'homme`` gives ``homme``), and is a token of its
    own elsewhere (``mae'r`` gives ``mae``, ``r``). ``lang`` is a code, a
    column of codes, or None (no language rule).
    """
    # one native pass; the pattern is chosen per row, not the expression copied
    if lang is None or isinstance(lang, str):
        run = F.lit(ALPHA_RUN_LEFT if lang in APOSTROPHE_LEFT else ALPHA_RUN_RIGHT if lang in APOSTROPHE_RIGHT else ALPHA_RUN)
    else:
        run = (F.when(lang.isin(*APOSTROPHE_LEFT), F.lit(ALPHA_RUN_LEFT))
               .when(lang.isin(*APOSTROPHE_RIGHT), F.lit(ALPHA_RUN_RIGHT)).otherwise(F.lit(ALPHA_RUN)))
    return F.regexp_extract_all(_col(c), run, F.lit(0))


def split_sentences(c) -> Column:
    """TXT9: array of sentences, cut after runs of ``.!?`` followed by space."""
    return F.filter(F.split(_col(c), f"(?<=[.!?]){R.WS}+"), lambda s: s != "")


def rstrip_period(c) -> Column:
    """TXT10: strip, then drop trailing periods."""
    return F.regexp_replace(py_strip(c), "\\.+$", "")


def bpe_unjoin(c) -> Column:
    """TXT12: undo ``@@ `` subword joiners."""
    return F.regexp_replace(F.regexp_replace(_col(c), "@@ ", ""), "@@$", "")


def detruecase(words) -> Column:
    """TXT13a: upper-case the first letter of the first word and of every word
    after a sentence-end token (ending in ``. : ? !``).

    ``words`` must be an array *column* (e.g. ``split(text, ' ')`` selected
    first): the lambda reads the previous word by index.
    """
    words = _col(words)

    def cap(w, i):
        prev_end = F.element_at(words, F.greatest(i, F.lit(1))).rlike("[.:?!]$")
        first = F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))
        return F.when((i == 0) | prev_end, first).otherwise(w)
    return F.array_join(F.transform(words, cap), " ")


def detokenize(c) -> Column:
    """TXT13b: remove the space before closing and after opening punctuation."""
    x = F.regexp_replace(_col(c), " ([.,!?:;%)\\]}])", "$1")
    x = F.regexp_replace(x, "([(\\[{$£]) ", "$1")
    x = F.regexp_replace(x, " ' ", "'")
    return x


def pieces_to_text(arr) -> Column:
    """TXT14: subword pieces back to text (``▁`` marks a word start)."""
    return F.trim(F.replace(F.array_join(_col(arr), ""), F.lit("▁"), F.lit(" ")))


ID_SEP = "\x1f"


def translation_id(classifier, source, target) -> Column:
    """TXT15: stable 60-bit id from (classifier, source, target).

    md5 keeps the id equal across runs and engines (Python's ``hash`` is
    salted per process); 15 hex digits fit a positive BIGINT.
    """
    key = F.concat_ws(ID_SEP, _col(classifier), _col(source), _col(target))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def langs_label(source_lang, target_lang) -> Column:
    return F.concat_ws("-", _col(source_lang), _col(target_lang))


def fmt_mb(c) -> Column:
    """TXT16: megabytes to three significant digits (as a number)."""
    c = _col(c)
    return F.when(c == 0, F.lit(0.0)).otherwise(_round_sig(c))


def _round_sig(c: Column) -> Column:
    # round to 3 significant digits: shift by the magnitude, bround, shift back
    mag = F.floor(F.log10(F.abs(c)))
    scale = F.pow(F.lit(10.0), F.lit(2) - mag)
    return F.round(c * scale) / scale


def fmt_hours(c) -> Column:
    """TXT16: hours to two decimals."""
    return F.round(_col(c), 2)
