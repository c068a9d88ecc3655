"""DuckDB SQL fragments that mirror :mod:`corpusflow.functions.text`.

Used only to write the oracle queries; generated from the same fixed rule
tables so that both engines apply the same rules in the same order.
"""

from __future__ import annotations

from functools import reduce

from corpusflow.functions import rules as R

q = R.sql_str


def apply_rules(x: str, rule_list) -> str:
    return reduce(lambda acc, r: R.sql_regexp_replace(acc, r[0], r[1]), rule_list, x)


def fix_whitespace(x: str) -> str:
    return f"replace(replace(replace({x}, chr(13) || chr(10), chr(10)), chr(10), ' '), chr(9), '    ')"


def strip_control(x: str) -> str:
    return f"regexp_replace({x}, '\\p{{C}}', '', 'g')"


def py_strip(x: str) -> str:
    return f"trim({x}, {q(R.PY_SPACE_CHARS)})"


def normalize_punct(x: str, lang: str | None, lang_is_col: bool = False) -> str:
    if not lang_is_col:
        return py_strip(apply_rules(x, R.punct_rules(lang)))
    common = apply_rules(x, R.PUNCT_COMMON)
    en = ", ".join(q(v) for v in R.QUOTE_COMMA_LANGS_EN)
    eu = ", ".join(q(v) for v in R.QUOTE_COMMA_LANGS_EU)
    nc = ", ".join(q(v) for v in R.NUMBER_COMMA_LANGS)
    quoted = (f"(CASE WHEN {lang} IN ({en}) THEN {apply_rules(common, R.PUNCT_EN_QUOTE_COMMA)} "
              f"WHEN {lang} IN ({eu}) THEN {apply_rules(common, R.PUNCT_DE_ES_FR_QUOTE_COMMA)} "
              f"ELSE {common} END)")
    numbers = (f"(CASE WHEN {lang} IN ({nc}) THEN {apply_rules(quoted, R.PUNCT_NUMBER_COMMA)} "
               f"ELSE {apply_rules(quoted, R.PUNCT_NUMBER_DOT)} END)")
    return py_strip(numbers)


def keep_lang_chars(x: str, lang: str | None, lang_is_col: bool = False) -> str:
    if not lang_is_col:
        pat = R.keep_pattern(lang) if lang else None
        return f"regexp_replace({x}, {q(pat)}, '', 'g')" if pat else x
    branches = " ".join(
        f"WHEN {lang} = {q(code)} THEN regexp_replace({x}, {q(R.keep_pattern(code))}, '', 'g')"
        for code in R.KEEP_EXTRA)
    return f"(CASE {branches} ELSE {x} END)"


def normalize(x: str, lang: str | None = None, lang_is_col: bool = False) -> str:
    y = strip_control(fix_whitespace(x))
    y = normalize_punct(y, lang, lang_is_col)
    y = keep_lang_chars(y, lang, lang_is_col)
    return py_strip(y)


def translation_id(classifier: str, source: str, target: str) -> str:
    key = f"concat_ws(chr(31), {classifier}, {source}, {target})"
    return f"CAST('0x' || substr(md5({key}), 1, 15) AS BIGINT)"


def alpha_tokens(x: str, lang: str | None = "lang") -> str:
    """Chunks of letters alone, after the chunk that an apostrophe binds is taken out."""
    left = f"regexp_replace({x}, '([\\p{{L}}\\p{{N}}])(?:''[\\p{{L}}\\p{{N}}\\-]+)+', '\\1 ', 'g')"
    right = f"regexp_replace({x}, '(?:[\\p{{L}}\\p{{N}}\\-]+'')+(\\p{{L}})', ' \\1', 'g')"
    cut = f"CASE WHEN {lang} IN ('en') THEN {left} WHEN {lang} IN ('fr', 'it') THEN {right} ELSE {x} END" if lang else x
    return (f"list_filter(regexp_split_to_array({cut}, '[^\\p{{L}}\\p{{N}}\\-]+'), "
            f"lambda t: regexp_full_match(t, '\\p{{L}}+'))")


# --- Fixture SQL (F1, F5) -----------------------------------------------------

def classifier_sql(col: str = "source") -> str:
    from corpusflow.plans.fixtures import HEALTH_SOURCES, OTHER_SOURCES
    h = ", ".join(q(s) for s in HEALTH_SOURCES)
    o = ", ".join(q(s) for s in OTHER_SOURCES)
    return f"CASE WHEN {col} IN ({h}) THEN 'Health' WHEN {col} IN ({o}) THEN 'Other' ELSE 'Unknown' END"


F1 = f"""
SELECT doc_id, CAST(i AS BIGINT) AS line_no, {classifier_sql('source')} AS classifier,
       lines[i] AS source, lines[i + 1] AS target,
       lang AS source_lang, lang AS target_lang, lang || '-' || lang AS langs
FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS lines FROM documents
      WHERE len(string_split(text, chr(10))) > 1) d,
     LATERAL (SELECT unnest(range(1, len(d.lines))) AS i) r
"""

CORPUS = f"""
SELECT {translation_id('classifier', 'source', 'target')} AS id, classifier, source, target, langs
FROM ({F1}) f1
"""

F5 = f"""
SELECT doc_id, line_no, source AS src, target AS ref,
       array_to_string(list_filter(string_split(target, ' '), lambda w, i: i % 7 <> 0), ' ') AS hyp
FROM ({F1}) f1
"""


def units_sql() -> str:
    """F1b with both sides already in the order of their pair."""
    from corpusflow.plans.fixtures import CODE_ONLY, LEADER, UNIT_PAIRS
    swap = ", ".join(q(f"{b}-{a}") for a, b in UNIT_PAIRS)
    return f"""
SELECT doc_id, line_no, classifier, CASE WHEN sw THEN target ELSE source END AS source,
       CASE WHEN sw THEN source ELSE target END AS target,
       CASE WHEN sw THEN target_lang ELSE source_lang END AS source_lang,
       CASE WHEN sw THEN source_lang ELSE target_lang END AS target_lang
FROM (SELECT *, source_lang || '-' || target_lang IN ({swap}) AS sw FROM (
  SELECT a.doc_id, CAST(i AS BIGINT) AS line_no, a.classifier, a.lang AS source_lang, b.lang AS target_lang,
         CASE WHEN (a.doc_id + i) % {CODE_ONLY[0]} = {CODE_ONLY[1]} THEN a.lang ELSE a.lines[i] END AS source,
         CASE WHEN (a.doc_id + i) % {LEADER[0]} = {LEADER[1]} THEN '-- ' || b.lines[i] ELSE b.lines[i] END AS target
  FROM (SELECT doc_id, lang, {classifier_sql('source')} AS classifier, string_split(text, chr(10)) AS lines FROM documents) a
  JOIN (SELECT doc_id - 1 AS doc_id, lang, string_split(text, chr(10)) AS lines FROM documents) b USING (doc_id),
       LATERAL (SELECT unnest(range(1, greatest(len(a.lines), len(b.lines)) + 1)) AS i) r) u) v"""
