"""Vocabulary building (VOC1-VOC4)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.text import alpha_tokens


def vocab_input(lines: DataFrame, max_lines: int | None = None, max_bytes: int | None = None,
                seed=42, text: str = "text") -> DataFrame:
    """VOC1: the lines that a vocabulary is made from; all of them by default.

    ``max_bytes`` leaves out longer lines and ``max_lines`` keeps that many,
    the smallest by a seeded hash. Repeated lines are counted first and the cut
    is made on the counts, so a popular line is one row until the end.
    """
    ok = lines.select(F.col(text).alias("text"))
    if max_bytes is not None:
        ok = ok.where(F.octet_length("text") <= max_bytes)
    if max_lines is None:
        return ok
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("text")))
    counts = ok.groupBy("text").agg(F.count(F.lit(1)).alias("_n")).withColumn("_h", h).withColumn("_b", F.substring("_h", 1, 4))
    # at most 65,536 hash buckets, whatever the corpus
    before = Window.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.groupBy("_b").agg(F.sum("_n").alias("_bn")).select(
        "_b", F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_before")).where(F.col("_before") < max_lines)
    inside = Window.partitionBy("_b").orderBy("_h", "text").rowsBetween(Window.unboundedPreceding, -1)
    kept = counts.join(buckets, "_b").withColumn(
        "_left", F.lit(max_lines) - F.col("_before") - F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    copies = F.least("_n", "_left").cast("int")
    return kept.where(F.col("_left") > 0).select("text", F.explode(F.array_repeat(F.lit(0), copies))).select("text")


def word_vocab(df: DataFrame, n: int, text: str = "text", lang=None) -> DataFrame:
    """VOC4: ``rank, word, count`` of the ``n`` most frequent words (ties by word).

    A top-n report: the limit is the feature; ``orderBy().limit()`` plans as
    TakeOrderedAndProject over the aggregated counts, and the rank is taken
    over its n rows.
    """
    counts = (df.select(F.explode(alpha_tokens(F.col(text), lang)).alias("word"))
              .groupBy("word").agg(F.count(F.lit(1)).alias("count")))
    order = [F.col("count").desc(), F.col("word")]
    top = counts.orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


# --- subword vocabulary (VOC2, VOC3) ------------------------------------------------
WORD_START = "▁"
EOS_ID, UNK_ID = 0, 1
#: merge rounds that are replayed before the word table is written anew
REPLAYED = 16
#: pairs that a task adds up before it passes them on
MOST_PAIRS = 1_000_000
#: texts encoded at a time
SLICE = 2048


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Whitespace words with counts: the only table the merge rounds touch."""
    words = F.filter(F.split(F.trim(F.col(text)), r"\s+"), lambda w: w != "")
    return df.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def _symbols(word) -> F.Column:
    return F.regexp_extract_all(F.concat(F.lit(WORD_START), word), F.lit("(?s)."), 0)


def merge_round(symbols: list[str], merges: dict[tuple[str, str], str]) -> list[str]:
    """One left-to-right pass that merges the adjacent pairs in ``merges``."""
    out: list[str] = []
    for s in symbols:
        if out and (new := merges.get((out[-1], s))) is not None:
            out[-1] = new
        else:
            out.append(s)
    return out


def choose_round(candidates, most: int) -> dict[tuple[str, str], str]:
    """Pairs to merge together, in the given order: no two share a symbol, and
    none has a result of the round as a symbol, so one pass is exact."""
    chosen: dict[tuple[str, str], str] = {}
    used: set[str] = set()
    made: set[str] = set()
    for a, b in candidates:
        if len(chosen) >= most:
            break
        if {a, b} & (used | made) or a + b in used or a + b in made:
            continue
        chosen[a, b] = a + b
        used |= {a, b}
        made.add(a + b)
    return chosen


class Merges:
    """Merge rounds on symbol numbers, for many words at once: ``symbols`` are
    the characters, in order, and what the rounds make of them."""

    def __init__(self, chars, rounds=()):
        self.symbols = sorted(chars)
        self.points = np.array([ord(c) for c in self.symbols], np.int64)
        self.at = {c: i for i, c in enumerate(self.symbols)}
        self.rounds: list[np.ndarray] = []
        for merges in rounds:
            self.add(merges)

    def add(self, merges: dict[tuple[str, str], str]) -> None:
        # a pair with a symbol that nothing has made yet occurs nowhere
        known = [(a, b, new) for (a, b), new in merges.items() if a in self.at and b in self.at]
        for *_, new in known:
            if new not in self.at:
                self.at[new] = len(self.symbols)
                self.symbols.append(new)
        self.rounds.append(np.array([[self.at[x] for x in pair] for pair in known], np.int32).reshape(-1, 3))

    def numbered(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """The numbers of the characters of the marked ``words``, the word each is
        of, and the symbols by number; unknown characters come behind the known."""
        points = np.array(memoryview("".join([WORD_START + w for w in words]).encode("utf-32-le")).cast("I"), np.int64)
        owner = np.repeat(np.arange(len(words)), np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))
        flat = np.searchsorted(self.points, points).astype(np.int32)
        new = np.flatnonzero(np.append(self.points, -1)[flat] != points)
        unknown, which = np.unique(points[new], return_inverse=True)
        flat[new] = len(self.symbols) + which
        return flat, owner, self.symbols + [chr(c) for c in unknown]

    def replayed(self, flat: np.ndarray, owner: np.ndarray, since: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """``merge_round`` on all words, for the rounds from ``since`` on.

        No two pairs of a round share a symbol. So a symbol has one partner, and
        only pairs of a symbol with itself overlap: every other one of a run counts.
        """
        partner, made = (np.full(max(len(self.symbols), flat.max(initial=0) + 1), -1, np.int32) for _ in range(2))
        for a, b, new in (r.T for r in self.rounds[since:]):
            partner[a], made[a] = b, new
            at = np.flatnonzero((partner[flat[:-1]] == flat[1:]) & (owner[:-1] == owner[1:]))
            partner[a] = -1
            if not len(at):
                continue
            n = np.arange(len(at))
            at = at[(n - np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, n, 0))) % 2 == 0]
            left = np.ones(len(flat), bool)
            left[at + 1] = False
            flat = flat.copy()
            flat[at] = made[flat[at]]
            flat, owner = flat[left], owner[left]
        return flat, owner


def _lists(flat: np.ndarray, owner: np.ndarray, n: int, of=None) -> pa.ListArray:
    """One list for each of ``n`` words: its symbol numbers, or those of ``of``."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    values = pa.array(flat, pa.int32())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values if of is None else pa.array(of, pa.string()).take(values))


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    codes = batch.column("codes")
    sizes = pc.list_value_length(codes).to_numpy(zero_copy_only=False)
    return codes.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(codes)), sizes)


def _pair_counts(words: DataFrame, merges: Merges, since: int) -> DataFrame:
    """``a, b, f``: adjacent symbols in ``words(cnt, codes)`` after the rounds from
    ``since`` on, by word frequency; a task adds up its own before the shuffle."""
    def run(batches):
        sums: dict[int, int] = {}
        names, n = pa.array(merges.symbols, pa.string()), len(merges.symbols)

        def rows():
            a, b = np.divmod(np.fromiter(sums, np.int64, len(sums)), n)
            return pa.RecordBatch.from_arrays([names.take(pa.array(a)), names.take(pa.array(b)), pa.array(list(sums.values()), pa.int64())],
                                              names=["a", "b", "f"])

        for batch in batches:
            flat, owner = merges.replayed(*_codes(batch), since)
            at = np.flatnonzero(owner[:-1] == owner[1:])
            if not len(at):
                continue
            key = flat[at].astype(np.int64) * n + flat[at + 1]
            order = np.argsort(key)
            key, cnt = key[order], batch.column("cnt").to_numpy(zero_copy_only=False)[owner[at[order]]]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            for k, f in zip(key[first].tolist(), np.add.reduceat(cnt, first).tolist()):
                sums[k] = sums.get(k, 0) + f
            if len(sums) > MOST_PAIRS:
                yield rows()
                sums.clear()
        if sums:
            yield rows()

    return words.select("cnt", "codes").mapInArrow(run, "a string, b string, f long").groupBy("a", "b").agg(F.sum("f").alias("f"))


def _words_with(words: DataFrame, column: str, of, cols=("word", "cnt")) -> DataFrame:
    """``cols`` of ``words`` and a ``column`` (with its type) made of each batch."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in cols), of(b)], names=[*cols, column.split()[0]])
    types = {"word": "word string", "cnt": "cnt long"}
    return words.mapInArrow(run, ", ".join([*(types[c] for c in cols), column]))


def train_subwords(df: DataFrame, size: int = 8000, per_round: int = 200, text: str = "text"):
    """VOC2: merge-based subword vocabulary of ``size`` pieces (fewer only where
    no pair is left to merge).

    The corpus is read once, into a table of distinct words with counts, whose
    symbols are numbers from then on. Rounds: count adjacent symbol pairs weighted
    by word frequency (one pass over the word table that replays the rounds since
    it was written, one aggregate) and take up to ``per_round`` top pairs that do
    not touch one another (a bounded list on the driver). The word table is
    written anew every ``REPLAYED`` rounds. Returns (vocab ``piece, id``; words
    ``word, pieces``; the rounds, for words not seen in training). Full character
    coverage; ids: eos = 0, unk = 1, no bos.
    """
    words = _written(word_counts(df, text))
    chars = words.select(F.explode(_symbols(F.col("word"))).alias("piece")).distinct()
    n_pieces, rounds = chars.count(), []
    if n_pieces < size - 2:
        # fewer characters than ``size``
        merges, done = Merges(r["piece"] for r in chars.collect()), 0
        words = _written(_words_with(words, "codes array<int>", lambda b: _lists(*merges.numbered(b.column("word").to_pylist())[:2], b.num_rows)))
    while (budget := size - 2 - n_pieces) > 0:
        if len(rounds) - done == REPLAYED:
            words = _written(_words_with(words, "codes array<int>", lambda b: _lists(*merges.replayed(*_codes(b), done), b.num_rows)))
            done = len(rounds)
        pairs = _pair_counts(words, merges, done).orderBy(F.col("f").desc(), "a", "b").limit(4 * per_round)
        # what conflicts waits for a later round
        chosen = choose_round(((r["a"], r["b"]) for r in pairs.collect()), min(per_round, budget))
        if not chosen:
            break
        rounds.append(chosen)
        merges.add(chosen)
        n_pieces += len(chosen)
    if "codes" in words.columns:
        words = _words_with(words, "pieces array<string>", lambda b: _lists(*merges.replayed(*_codes(b), done), b.num_rows, merges.symbols), ("word",))
    else:
        words = words.select("word", _symbols(F.col("word")).alias("pieces"))
    spark = df.sparkSession
    merged = [(p,) for rnd in rounds for p in rnd.values()]
    pieces = chars.unionByName(spark.createDataFrame(merged, "piece string")) if merged else chars
    specials = spark.createDataFrame([("</s>", EOS_ID), ("<unk>", UNK_ID)], "piece string, id long")
    # the vocabulary has at most ``size`` rows, so one ordered partition is bounded
    ranked = pieces.distinct().withColumn(
        "id", F.lit(1) + F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("piece")))
    return specials.unionByName(ranked.select("piece", F.col("id").cast("long"))), words, rounds


def _written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the session's shared folder."""
    import uuid
    from corpusflow.session import checkpoint_dir
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/subwords/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def encode(df: DataFrame, words: DataFrame, rounds, key: str, text: str = "text") -> DataFrame:
    """VOC3: text -> pieces, by the merge rounds; texts without words have no row.

    A task replays the rounds on the distinct words of many texts at once. That
    gives words seen in training the pieces they have in ``words``, so that table
    is not joined and no word becomes a row. ``key`` is unique per text; the
    words of texts that share one are taken in turns.
    """
    split = lambda t: F.filter(F.split(F.trim(t), r"\s+"), lambda w: w != "")
    texts = df.groupBy(key).agg(F.collect_list(text).alias("_t")).select(key, F.transform("_t", split).alias("_t"))
    merges = Merges({c for merges in rounds for pair in merges for c in pair if len(c) == 1}, rounds)

    def pieces(texts: pa.ListArray) -> pa.ListArray:
        lists = texts.flatten()
        words = lists.flatten().dictionary_encode()
        at = words.indices.to_numpy(zero_copy_only=False).copy()
        flat, owner, names = merges.numbered(words.dictionary.to_pylist())
        found = _lists(*merges.replayed(flat, owner), len(words.dictionary), names)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        ends_of = np.concatenate([[0], np.cumsum(pc.list_value_length(texts).to_numpy(zero_copy_only=False))]).astype(np.int64)
        for row in np.flatnonzero(np.diff(ends_of) > 1):
            own = ends[ends_of[row]:ends_of[row + 1] + 1]
            turns = sorted((i - s, found[at[i]].as_py(), at[i]) for s, e in zip(own, own[1:]) for i in range(s, e))
            at[own[0]:own[-1]] = [w for *_, w in turns]
        sizes = np.concatenate([[0], np.cumsum(pc.list_value_length(found).to_numpy(zero_copy_only=False)[at])])
        return pa.ListArray.from_arrays(pa.array(sizes[ends[ends_of]], pa.int32()), found.take(pa.array(at)).flatten())

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                b = batch.slice(i, SLICE)
                yield pa.RecordBatch.from_arrays([b.column(0), pieces(b.column(1))], names=[key, "pieces"])

    fields = T.StructType([df.schema[key], T.StructField("pieces", T.ArrayType(T.StringType()))])
    return texts.mapInArrow(run, fields).where(F.size("pieces") > 0)
