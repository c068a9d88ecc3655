"""Fixed-value rule tables shared by the Spark columns and the SQL oracle.

Patterns are written in the common subset of Java regex and RE2 (no
look-around, ``\\x{..}`` escapes, ``\\p{..}`` classes); replacements use
``\\1`` group references and are converted for Java by :func:`java_repl`.
"""

from __future__ import annotations

import re

# --- FIXED VALUES: whitespace as Python's str.isspace() sees it -------------
# Tab, LF, VT, FF, CR, FS, GS, RS, US, space, NEL, NBSP, Ogham space mark,
# en quad .. hair space, line separator, paragraph separator, narrow NBSP,
# medium mathematical space, ideographic space.
PY_SPACE = ("\\t\\n\\x{0b}\\x{0c}\\r\\x{1c}-\\x{1f} \\x{85}\\x{a0}\\x{1680}"
            "\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}")
WS = f"[{PY_SPACE}]"
# The same set as literal characters, for trim().
PY_SPACE_CHARS = ("\t\n\x0b\x0c\r" + "".join(chr(c) for c in range(0x1c, 0x20)) + " \x85\xa0\u1680"
                  + "".join(chr(c) for c in range(0x2000, 0x200b)) + "\u2028\u2029\u202f\u205f\u3000")

# Python's \d on str is the Unicode decimal-digit category.
DIGIT = "\\p{Nd}"

# --- FIXED VALUES: whitespace fixes applied to raw unit text (in order) ------
# CRLF -> LF, LF -> one space, tab -> four spaces.
RAW_REPLACEMENTS = (("\r\n", "\n"), ("\n", " "), ("\t", "    "))

# --- FIXED VALUES: Moses punctuation normalisation (sacremoses 0.0.46) ------
# Order matters; groups below are applied in the order listed.
PUNCT_EXTRA_WHITESPACE = (
    ("\\r", ""),
    ("\\(", " ("),
    ("\\)", ") "),
    (" +", " "),
    ("\\) ([.!:?;,])", ")\\1"),
    ("\\( ", "("),
    (" \\)", ")"),
    (f"({DIGIT}) %", "\\1%"),
    (" :", ":"),
    (" ;", ";"),
)
PUNCT_PENN = (
    ("`", "'"),
    ("''", ' " '),
)
PUNCT_UNICODE = (
    ("„", '"'),
    ("“", '"'),
    ("”", '"'),
    ("–", "-"),
    ("—", " - "),
    (" +", " "),
    ("´", "'"),
    ("([a-zA-Z])‘([a-zA-Z])", "\\1'\\2"),
    ("([a-zA-Z])’([a-zA-Z])", "\\1'\\2"),
    ("‘", "'"),
    ("‚", "'"),
    ("’", "'"),
    ("''", '"'),
    ("´´", '"'),
    ("…", "..."),
)
PUNCT_FRENCH_QUOTES = (
    ("\\x{a0}«\\x{a0}", '"'),
    ("«\\x{a0}", '"'),
    ("«", '"'),
    ("\\x{a0}»\\x{a0}", '"'),
    ("\\x{a0}»", '"'),
    ("»", '"'),
)
PUNCT_PSEUDO_SPACES = (
    ("\\x{a0}%", "%"),
    ("nº\\x{a0}", "nº "),
    ("\\x{a0}:", ":"),
    ("\\x{a0}ºC", " ºC"),
    ("\\x{a0}cm", " cm"),
    ("\\x{a0}\\?", "?"),
    ("\\x{a0}!", "!"),
    ("\\x{a0};", ";"),
    (",\\x{a0}", ", "),
    (" +", " "),
)
PUNCT_EN_QUOTE_COMMA = (
    ('"([,.]+)', '\\1"'),
)
PUNCT_DE_ES_FR_QUOTE_COMMA = (
    (',"', '",'),
    (f'(\\.+)"({WS}*[^<])', '"\\1\\2'),
)
PUNCT_NUMBER_COMMA = ((f"({DIGIT})\\x{{a0}}({DIGIT})", "\\1,\\2"),)
PUNCT_NUMBER_DOT = ((f"({DIGIT})\\x{{a0}}({DIGIT})", "\\1.\\2"),)

QUOTE_COMMA_LANGS_EN = ("en",)
QUOTE_COMMA_LANGS_EU = ("de", "es", "fr")
NUMBER_COMMA_LANGS = ("de", "es", "cz", "cs", "fr")

PUNCT_COMMON = (PUNCT_EXTRA_WHITESPACE + PUNCT_PENN + PUNCT_UNICODE
                + PUNCT_FRENCH_QUOTES + PUNCT_PSEUDO_SPACES)

# --- FIXED VALUES: per-language keep-lists -----------------------------------
# Characters outside these sets are removed. ",-." is a range, so "-" stays.
KEEP_BASE = "a-zA-Z0-9" + PY_SPACE + "'(),-.:;!?%£$/"
KEEP_EXTRA = {
    "cy": "ÁÂÄÉÊËÎÏÔÖÔÛŴŶáâäéêëîïôöôûŵŷ",
    "en": "",
}

# Leading run of two or more of "_", "-", "." (mixed allowed).
LEADER_PATTERN = "^[_\\-.]{2,}"

# Wordfast inline tags such as &tA;
WORDFAST_TAG = "&t[A-Z];"

# --- FIXED VALUES: sacreBLEU 13a tokenizer (sacrebleu 2.0.0) ------------------
TOK13A_RULES = (
    ("([{-~\\[-` -&(-+:-@/])", " \\1 "),
    ("([^0-9])([.,])", "\\1 \\2 "),
    ("([.,])([^0-9])", " \\1 \\2"),
    ("([0-9])(-)", "\\1 \\2 "),
)
TOK13A_ENTITIES = (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))


def keep_chars(lang: str) -> str | None:
    """The keep-list as literal characters (for a ``translate`` pre-check)."""
    extra = KEEP_EXTRA.get(lang)
    if extra is None:
        return None
    ascii_part = "".join(chr(c) for c in range(ord("a"), ord("z") + 1))
    ascii_part += ascii_part.upper() + "0123456789" + "'()" + ",-." + ":;!?%£$/"
    return ascii_part + PY_SPACE_CHARS + extra


def keep_pattern(lang: str) -> str | None:
    extra = KEEP_EXTRA.get(lang)
    if extra is None:
        return None
    return f"[^{KEEP_BASE}{extra}]"


def punct_rules(lang: str | None) -> tuple:
    """Ordered Moses rules for one language (None = no language rules)."""
    rules = PUNCT_COMMON
    if lang in QUOTE_COMMA_LANGS_EN:
        rules = rules + PUNCT_EN_QUOTE_COMMA
    elif lang in QUOTE_COMMA_LANGS_EU:
        rules = rules + PUNCT_DE_ES_FR_QUOTE_COMMA
    if lang in NUMBER_COMMA_LANGS:
        rules = rules + PUNCT_NUMBER_COMMA
    else:
        rules = rules + PUNCT_NUMBER_DOT
    return rules


_GROUP_REF = re.compile(r"\\(\d)")
_META = set(".^$*+?()[]{}|\\")


def literal_of(pattern: str) -> str | None:
    """The plain string a pattern matches, or None if it needs regex."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            nxt = pattern[i + 1]
            if nxt == "x" and pattern[i + 2] == "{":
                end = pattern.index("}", i)
                out.append(chr(int(pattern[i + 3:end], 16)))
                i = end + 1
                continue
            if nxt in "r":
                out.append("\r")
            elif nxt in _META:
                out.append(nxt)
            else:
                return None
            i += 2
            continue
        if ch in _META:
            return None
        out.append(ch)
        i += 1
    return "".join(out)


def java_repl(repl: str) -> str:
    """Convert a ``\\1`` replacement into Java's ``$1`` form."""
    out = repl.replace("\\", "\\\\").replace("$", "\\$")
    return re.sub(r"\\\\(\d)", r"$\1", out)


def sql_str(s: str) -> str:
    """SQL string literal for DuckDB."""
    return "'" + s.replace("'", "''") + "'"


def sql_regexp_replace(expr: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({expr}, {sql_str(pattern)}, {sql_str(repl)}, 'g')"


# --- FIXED VALUES: literal trigger of each regex rule -----------------------------
# A regex rule can only change a text that contains its trigger, so it is
# skipped (no regex engine, no UTF-16 copy) when a byte search finds none.
GUARDS = {
    " +": "  ",
    "\\) ([.!:?;,])": ") ",
    f"({DIGIT}) %": " %",
    "([a-zA-Z])‘([a-zA-Z])": "‘",
    "([a-zA-Z])’([a-zA-Z])": "’",
    '"([,.]+)': '"',
    f'(\\.+)"({WS}*[^<])': '."',
    f"({DIGIT})\\x{{a0}}({DIGIT})": "\xa0",
}
