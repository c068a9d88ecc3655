"""Language identification as a train-and-score Spark job (LID1, LID2, FLT5).

The reference calls a per-sentence detector library. Here a character
trigram profile, which keeps every trigram seen, is trained from labelled text
with one aggregate. Its rows are counted; while they are few enough the profile
is packed into arrays (sorted trigrams, one row of gains for each language) and
broadcast, and a text is scored where it is, by one lookup and one sum for each
language: no trigram becomes a row and nothing is shuffled. A larger profile
meets the texts' trigrams by a join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 3
DEFAULT_MARGIN = 0.05  # minimum score gap per trigram between best and runner-up
#: rows of a profile, and cells of its arrays (8 bytes each), that are broadcast at most
PACKED_ROWS, PACKED_CELLS = 1 << 21, 1 << 23
#: characters of text scored at a time
CHARACTERS = 1 << 20


def padded(c) -> F.Column:
    return F.concat(F.lit(" "), F.lower(c), F.lit(" "))


def char_grams(c, n: int = GRAM) -> F.Column:
    """All overlapping character n-grams of ``c`` in one native regex pass.

    A zero-width lookahead captures the n code points at every position, so
    there is no per-element lambda and no ``substring`` walk (either would
    cost per gram, or quadratic time in the text length).
    """
    # each match takes one code point, so none starts inside a surrogate pair
    return F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{n}}}))."), 1)


def train_lang_profile(df: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """LID1: ``(lang, gram, cnt, logp, unseen_logp)`` of every trigram of each language.

    The explode is followed by a partial (map-side) aggregate, so the shuffle
    carries one row per (partition, lang, gram), not one per trigram. Add-one
    smoothing over the language's distinct trigrams; the totals are one row
    per language.
    """
    counts = (df.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
              .select(F.col(lang).alias("lang"), F.explode(char_grams(padded(F.col(text)))).alias("gram"))
              .groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("cnt")))
    totals = counts.groupBy("lang").agg((F.sum("cnt") + F.count(F.lit(1))).alias("denom"))
    return counts.join(totals, "lang").select(
        "lang", "gram", "cnt", F.log((F.col("cnt") + 1) / F.col("denom")).alias("logp"),
        F.log(F.lit(1.0) / F.col("denom")).alias("unseen_logp"))


def gram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of padded texts as numbers, and the place of each one's text."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    if len(points) < GRAM:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    of = np.repeat(np.arange(len(texts)), size)
    inside = of[GRAM - 1:] == of[:1 - GRAM]
    codes = points[:-2] << 42 | points[1:-1] << 21 | points[2:]
    return codes[inside], of[:1 - GRAM][inside]


class PackedProfile:
    """A profile as arrays: sorted trigrams and, by language, what each of them gains."""

    def __init__(self, rows):
        langs = sorted(set(rows["lang"]))
        at = {x: i for i, x in enumerate(langs)}
        own = np.array([at[x] for x in rows["lang"]], np.int64)
        grams = list(rows["gram"])
        codes = gram_codes(grams)[0] if grams else np.empty(0, np.int64)
        self.langs, self.unseen = langs, np.zeros(len(langs))
        self.unseen[own] = rows["unseen_logp"]
        self.codes, place = np.unique(codes, return_inverse=True)
        self.gains = np.zeros((len(langs), len(self.codes) + 1))  # the last column is for unseen trigrams
        self.gains[own, place] = rows["logp"] - rows["unseen_logp"]

    def detect(self, texts: list[str], margin: float) -> list[str | None]:
        """Language of each padded text, None where it is not reliable."""
        codes, of = gram_codes(texts)
        at = np.searchsorted(self.codes, codes)
        known = np.append(self.codes, -1)[at] == codes
        at[~known] = len(self.codes)
        n = np.bincount(of, minlength=len(texts))
        score = np.full((len(self.langs) + 2, len(texts)), -np.inf)
        for i, gains in enumerate(self.gains):
            gain = np.bincount(of, gains[at], len(texts))
            # every trigram seen in a language gains something
            score[i] = np.where(gain > 0, gain + self.unseen[i] * n, -np.inf)
        best = score.argmax(axis=0)
        first, second = np.sort(score, axis=0)[:-3:-1]
        with np.errstate(invalid="ignore", divide="ignore"):
            good = (first > -np.inf) & ((second == -np.inf) | ((first - second) / n >= margin))
        return [self.langs[i] if ok else None for i, ok in zip(best.tolist(), good.tolist())]


def detect_lang(df: DataFrame, profile: DataFrame, text: str = "text", margin: float = DEFAULT_MARGIN,
                packed_rows: int = PACKED_ROWS) -> DataFrame:
    """LID2: add ``detected`` (null when not reliable) to ``df``.

    Score of language L = sum over the text's trigrams of log p(g|L), with
    unseen grams at L's unseen probability; only languages sharing at least one
    trigram with the text are candidates. A text is reliable when the best score
    beats the runner-up by ``margin`` per trigram. Null and empty texts have no
    language.
    """
    # one row more than may be packed tells whether it is too large
    rows = profile.select("lang", "gram", "logp", "unseen_logp").limit(packed_rows + 1).toPandas()
    if len(rows) > packed_rows or rows["lang"].nunique() * rows["gram"].nunique() > PACKED_CELLS:
        return detect_by_join(df, profile, text, margin)
    packed = df.sparkSession.sparkContext.broadcast(PackedProfile(rows))

    @F.arrow_udf("string")
    def language(texts: pa.Array) -> pa.Array:
        out, waiting, size = [], [], 0
        for t in texts.to_pylist():
            waiting.append(t or "")
            size += len(waiting[-1])
            if size >= CHARACTERS:
                out += packed.value.detect(waiting, margin)
                waiting, size = [], 0
        return pa.array(out + packed.value.detect(waiting, margin), pa.string())

    return df.withColumn("detected", language(padded(F.col(text))))


def detect_by_join(df: DataFrame, profile: DataFrame, text: str = "text", margin: float = DEFAULT_MARGIN) -> DataFrame:
    """:func:`detect_lang` for a profile of any size: distinct texts are scored
    once, by a join of their trigrams with the profile, and joined back."""
    prof = profile.select("lang", "gram", (F.col("logp") - F.col("unseen_logp")).alias("gain"), "unseen_logp")
    # Texts are keyed by a 96-bit hash pair so long strings never travel
    # through the shuffles; the partial aggregate runs before the first one.
    key = F.when(F.col(text).isNotNull(), text_key(F.col(text)))  # null texts meet nothing
    texts = (df.select(key.alias("_k"), F.col(text).alias("_t")).where(F.col("_t").isNotNull())
             .dropDuplicates(["_k"]))
    texts = texts.select("_k", padded(F.col("_t")).alias("_p"))
    n_grams = F.greatest(F.length("_p") - (GRAM - 1), F.lit(0))  # O(1), not size(grams(...))
    texts = texts.select("_k", n_grams.alias("_g"), F.explode(char_grams(F.col("_p"))).alias("gram"))
    scored = (texts.join(prof, "gram")
              .groupBy("_k", "_g", "lang")
              .agg(F.sum("gain").alias("gain"), F.first("unseen_logp").alias("u"))
              .withColumn("score", F.col("gain") + F.col("u") * F.col("_g")))
    ranked = (scored.groupBy("_k", "_g")
              .agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("neg"), F.col("lang"))))
                   .alias("c")))
    best = F.element_at("c", 1)
    second = F.element_at("c", 2)
    gap = F.when(F.size("c") > 1, (second["neg"] - best["neg"]) / F.col("_g"))
    reliable = F.coalesce(gap >= F.lit(margin), F.lit(True))
    res = ranked.select("_k", F.when(reliable, best["lang"]).alias("detected"))
    return df.withColumn("_k", key).join(res, "_k", "left").drop("_k")


def text_key(c) -> F.Column:
    """96-bit key of a text (xxhash64 + murmur3) for grouping without the text."""
    return F.struct(F.xxhash64(c).alias("h1"), F.hash(c).alias("h2"))


def mismatched(df: DataFrame, profile: DataFrame, keys=("id",), margin: float = DEFAULT_MARGIN) -> DataFrame:
    """Distinct ``keys`` of units of which a side is not detected as its declared
    language. Both sides are one long table, scored in one pass."""
    sides = df.select(*keys, F.expr("stack(2, source_lang, source, target_lang, target) AS (_declared, _text)"))
    found = detect_lang(sides, profile, "_text", margin)
    return found.where(~F.coalesce(F.col("detected") == F.col("_declared"), F.lit(False))).select(*keys).distinct()


def lang_gate(df: DataFrame, profile: DataFrame, keys=("id",), margin: float = DEFAULT_MARGIN) -> DataFrame:
    """FLT5: mark units whose detected language differs from the declared one."""
    from corpusflow.operators.filters import LANG_MISMATCH
    flag = mismatched(df, profile, keys, margin).withColumn("_off", F.lit(LANG_MISMATCH))
    return df.join(flag, list(keys), "left").withColumn("reject_reason", F.coalesce("reject_reason", "_off")).drop("_off")
