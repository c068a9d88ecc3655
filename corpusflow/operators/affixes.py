"""Affix dictionaries (SPL2): ``.dic`` stems with flags, ``.aff`` rules.

The rules, a file of bounded size, are compiled into tables by ending and
beginning and travel to the tasks; the stems are a table. A distinct word
becomes the few ``(stem, flags it needs)`` that its endings and beginnings
allow, and one join with the stems on ``(lang, stem)`` tells whether one of them
is there with these flags. Words that are left are tried as compounds: a filter of
bounded size, of the stems that may stand in one, leaves of their parts those
that can lead from start to end; these are joined with the stems, and a word is
a compound if the parts found lead from its start to its end.
Nothing is expanded: the forms of a stem are never listed.

Read from ``.aff``: FLAG, PFX, SFX (strip, condition, cross product),
COMPOUNDFLAG, COMPOUNDMIN, FORBIDDENWORD, NEEDAFFIX. Flags behind an affix
(two suffixes on one stem), aliases and other commands are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.vocab import _written


@dataclass(frozen=True)
class Affix:
    flag: str
    strip: str
    add: str
    condition: str
    cross: bool


@dataclass
class Rules:
    """An ``.aff`` file: affixes by what they add, and what compounds need."""
    flags: str = "char"
    prefixes: dict[str, list[Affix]] = field(default_factory=dict)
    suffixes: dict[str, list[Affix]] = field(default_factory=dict)
    compound: str | None = None
    compound_min: int = 3
    forbidden: str | None = None
    need_affix: str | None = None

    def stems(self, word: str) -> list[tuple[str, tuple[str, ...]]]:
        """Stems that ``word`` can be a form of, with the flags they need."""
        out = [(word, ())]
        out += [(stem, (a.flag,)) for stem, a in self._without_suffix(word)]
        for rest, p in self._without_prefix(word):
            out.append((rest, (p.flag,)))
            if p.cross:
                out += [(stem, (p.flag, a.flag)) for stem, a in self._without_suffix(rest) if a.cross]
        return out

    def _without_suffix(self, word: str):
        for n in range(min(len(word), _longest(self.suffixes)) + 1):
            for a in self.suffixes.get(word[len(word) - n:], ()):
                stem = word[:len(word) - n] + a.strip
                if stem and re.search(f"(?:{a.condition})$", stem):
                    yield stem, a

    def _without_prefix(self, word: str):
        for n in range(min(len(word), _longest(self.prefixes)) + 1):
            for a in self.prefixes.get(word[:n], ()):
                stem = a.strip + word[n:]
                if stem and re.match(a.condition, stem):
                    yield stem, a


def _longest(table: dict) -> int:
    return max(map(len, table), default=-1)


def parse_rules(lines: Iterable[str]) -> Rules:
    """:class:`Rules` of the lines of an ``.aff`` file. Conditions are those of
    the format: ``.``, characters, ``[...]`` and ``[^...]``."""
    rules, cross = Rules(), {}
    for line in lines:
        word = line.split()
        if not word or word[0].startswith("#"):
            continue
        if word[0] == "FLAG":
            rules.flags = word[1].lower()
        elif word[0] == "COMPOUNDFLAG":
            rules.compound = word[1]
        elif word[0] == "COMPOUNDMIN":
            rules.compound_min = max(1, int(word[1]))
        elif word[0] == "FORBIDDENWORD":
            rules.forbidden = word[1]
        elif word[0] == "NEEDAFFIX":
            rules.need_affix = word[1]
        elif word[0] in ("PFX", "SFX") and len(word) >= 4:
            if (word[0], word[1]) not in cross:  # the header: flag, cross product, number of rules
                cross[word[0], word[1]] = word[2] == "Y"
                continue
            strip, add = ("" if x == "0" else x for x in (word[2], word[3].split("/")[0]))
            condition = "".join(x if x[0] in "[." else re.escape(x) for x in re.findall(r"\[[^\]]*\]|.", word[4] if len(word) > 4 else "."))
            table = rules.prefixes if word[0] == "PFX" else rules.suffixes
            affix = Affix(word[1], strip, add, condition if condition != "." else "", cross[word[0], word[1]])
            table.setdefault(add, []).append(affix)
    return rules


def read_rules(spark: SparkSession, path: str, encoding: str = "UTF-8") -> Rules:
    """The rules of an ``.aff`` file."""
    return parse_rules(r.value for r in spark.read.option("encoding", encoding).text(path, wholetext=False).collect())


def _flags(c: Column, kind: str) -> Column:
    if kind == "long":
        return F.regexp_extract_all(c, F.lit("(?s).."), 0)
    if kind == "num":
        return F.filter(F.split(c, ","), lambda x: x != "")
    return F.regexp_extract_all(c, F.lit("(?s)."), 0)


def parse_stems(lines: DataFrame, lang: str, rules: Rules) -> DataFrame:
    """``lang, stem, flags`` of the lines (``value``) of a ``.dic`` file: what
    follows white space is not looked at, nor is the count on its first line."""
    entry = F.regexp_extract("value", r"^\s*(\S+)", 1)
    d = lines.select(F.regexp_extract(entry, r"^((?:\\/|[^/])+)", 1).alias("stem"), F.regexp_extract(entry, r"^(?:\\/|[^/])+/(.*)$", 1).alias("f"))
    d = d.where((F.col("stem") != "") & ~F.col("stem").rlike("^[0-9]+$"))
    return d.select(F.lit(lang).alias("lang"), F.replace("stem", F.lit("\\/"), F.lit("/")).alias("stem"), _flags(F.col("f"), rules.flags).alias("flags"))


def read_stems(spark: SparkSession, path: str, lang: str, rules: Rules) -> DataFrame:
    return parse_stems(spark.read.text(path), lang, rules)


def case_forms(w) -> Column:
    """The forms of a word that may stand in the dictionary: itself; in lower
    case if it is Capitalised or UPPER; Capitalised if it is UPPER."""
    lower = F.lower(w)
    cap = F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))
    upper = w == F.upper(w)
    return F.array_distinct(F.array_compact(F.array(w, F.when(upper | (w == cap), lower), F.when(upper, cap))))


#: bits of the filter of compound parts; with more stems it lets more parts
#: through to the join
FILTER_BITS = 1 << 24


def _part_bits(parts: DataFrame) -> bytes:
    """A bit for the checksum of each ``lang, stem``, 2 MB in all."""
    at = F.crc32(F.encode(F.concat_ws("\x00", "lang", "stem"), "utf-8")) % FILTER_BITS + 1
    rows = (parts.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("k"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")))
    out = bytearray(FILTER_BITS // 8)
    for r in rows.collect():
        start = (r.k - 1) * len(r.bits)
        out[start:start + len(r.bits)] = r.bits
    return bytes(out)


def _spans(lang: str, form: str, bits: bytes, longest: int) -> list[tuple[int, int]]:
    """Parts of ``form`` that the filter knows and that lie on a way from start to end."""
    n, chars, first = len(form), [c.encode() for c in form], zlib.crc32(f"{lang}\x00".encode())
    starts: list[list[int]] = [[] for _ in range(n + 1)]
    for s in range(n):
        if s and not starts[s]:
            continue
        crc = first
        for e in range(s + 1, min(n, s + longest) + 1):
            crc = zlib.crc32(chars[e - 1], crc)
            at = crc % FILTER_BITS
            if bits[at >> 3] >> (at & 7) & 1 and e - s < n:
                starts[e].append(s)
    out, reach = [], {n}
    for e in range(n, 0, -1):
        if e in reach:
            reach.update(starts[e])
            out += [(s, e) for s in starts[e]]
    return out


class AffixDictionary:
    """Stems ``lang, stem, flags`` and the rules of each language."""

    def __init__(self, stems: DataFrame, rules: dict[str, Rules]):
        # a stem that stands twice has the flags of both
        self.stems = stems.groupBy("lang", "stem").agg(F.array_distinct(F.flatten(F.collect_list("flags"))).alias("flags"))
        self.rules = rules

    def _rule(self, name: str) -> Column:
        """A flag of the language's rules, null where it has none."""
        known = {lang: getattr(r, name) for lang, r in self.rules.items() if getattr(r, name) is not None}
        if not known:
            return F.lit(None).cast("string")
        return F.try_element_at(F.create_map(*(F.lit(str(x)) for kv in known.items() for x in kv)), F.col("lang"))

    def accepted(self, words: DataFrame) -> DataFrame:
        """Those ``lang, word`` (distinct) that are stems, forms or compounds."""
        rules = words.sparkSession.sparkContext.broadcast(self.rules)

        def strip(batches):
            for b in batches:
                rows = [(lang, word, stem, list(need)) for lang, word, form in zip(*(b.column(i).to_pylist() for i in range(3)))
                        for stem, need in rules.value.get(lang, Rules()).stems(form)]
                cols = list(zip(*rows)) if rows else [()] * 4
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in cols[:3]), pa.array(cols[3], pa.list_(pa.string()))],
                                                 names=["lang", "word", "stem", "need"])

        forms = words.select("lang", "word", F.explode(case_forms(F.col("word"))).alias("form"))
        tried = forms.mapInArrow(strip, "lang string, word string, stem string, need array<string>")
        none = F.lit(False)
        has = lambda name: F.coalesce(F.array_contains("flags", self._rule(name)), none)
        met = tried.join(self.stems, ["lang", "stem"]).where(F.size(F.array_except("need", "flags")) == 0)
        met = met.where(~has("forbidden") & ~((F.size("need") == 0) & has("need_affix"))).select("lang", "word").distinct()
        if all(r.compound is None for r in self.rules.values()):
            return met
        met = _written(met)
        return met.unionByName(self.compounds(words.join(met, ["lang", "word"], "left_anti")))

    def compounds(self, words: DataFrame) -> DataFrame:
        """Those ``lang, word`` that are two or more stems with the compound flag."""
        has = F.array_contains("flags", self._rule("compound"))
        parts = self.stems.where(has & (F.length("stem") >= F.coalesce(self._rule("compound_min").cast("int"), F.lit(3))))
        longest = parts.agg(F.max(F.length("stem"))).first()[0]
        if longest is None:
            return words.select("lang", "word").limit(0)
        bits = words.sparkSession.sparkContext.broadcast(_part_bits(parts))

        def cut(batches):
            for b in batches:
                rows = [(lang, word, form, s, e, form[s:e]) for lang, word, form in zip(*(b.column(i).to_pylist() for i in range(3)))
                        for s, e in _spans(lang, form, bits.value, longest)]
                cols = list(zip(*rows)) if rows else [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.string()] * 3 + [pa.int32()] * 2 + [pa.string()])],
                                                 names=["lang", "word", "form", "s", "e", "stem"])

        form = words.select("lang", "word", F.explode(case_forms(F.col("word"))).alias("form"))
        tried = form.mapInArrow(cut, "lang string, word string, form string, s int, e int, stem string")
        found = (tried.join(parts.select("lang", "stem"), ["lang", "stem"]).groupBy("lang", "word", "form")
                 .agg(F.collect_set(F.struct("s", "e")).alias("spans")))

        @F.arrow_udf("boolean")
        def leads(spans: pa.Array, sizes: pa.Array) -> pa.Array:
            out = []
            for row, n in zip(spans.to_pylist(), sizes.to_pylist()):
                reach = {0}
                for x in sorted(row, key=lambda x: (x["s"], x["e"])):
                    if x["s"] in reach and x["e"] - x["s"] < n:
                        reach.add(x["e"])
                out.append(n in reach)
            return pa.array(out, pa.bool_())

        return found.where(leads("spans", F.length("form"))).select("lang", "word").distinct()

    def unknown(self, toks: DataFrame) -> DataFrame:
        """``lang, word, n`` of the distinct words of ``toks`` that are not accepted."""
        words = _written(toks.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
        return words.join(self.accepted(words.select("lang", "word")), ["lang", "word"], "left_anti")
