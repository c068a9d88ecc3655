"""Corpus-level translation metrics (MET1-MET6) as aggregates.

Input: a table with the ``keys`` to score by (e.g. ``split_n``), ``ref`` and
``hyp``. One Arrow-batched projection turns each segment into sufficient
statistics (clipped n-gram matches, word edits, alignment hits; of many segments
at a time), one aggregate
sums them per key, and a closed form ends it. Segment text is never shuffled,
no n-gram becomes a row, and all splits and metrics come from one scan.

BLEU and chrF follow sacreBLEU 2.0.0 defaults (13a tokens, exp smoothing;
char order 6, beta 2, whitespace removed). WER/MER/WIL are word-level
Levenshtein statistics summed over segments; the edit rate (TER) also lets a
block of words move for one edit. Where a sum is divided
by no reference (or hypothesis) words the score is null.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import accumulate, chain, count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import rules as R

BLEU_ORDER = 4
CHRF_ORDER = 6
CHRF_BETA = 2.0


def _ws_split(c: Column) -> Column:
    """Python ``str.split()``: split on Unicode whitespace, no empty items."""
    return F.filter(F.split(c, f"{R.WS}+"), lambda t: t != "")


def tokenize_13a(c: Column) -> Column:
    """sacreBLEU 13a tokenizer: array of tokens."""
    x = F.replace(c, F.lit("<skipped>"), F.lit(""))
    x = F.replace(x, F.lit("-\n"), F.lit(""))
    x = F.replace(x, F.lit("\n"), F.lit(" "))
    for old, new in R.TOK13A_ENTITIES:
        x = F.replace(x, F.lit(old), F.lit(new))
    x = F.concat(F.lit(" "), x, F.lit(" "))
    for pat, rep in R.TOK13A_RULES:
        x = F.regexp_replace(x, pat, R.java_repl(rep))
    return _ws_split(x)


#: rule 1 of the tokenizer is of single characters
_SINGLE = {i: f" {chr(i)} " for i in range(128) if re.match(R.TOK13A_RULES[0][0], chr(i))}
#: two are of points and commas, the last one is of hyphens
*_POINTS, _HYPHENS = [(re.compile(pattern), repl) for pattern, repl in R.TOK13A_RULES[1:]]


def words_13a(x: str) -> list[str]:
    """:func:`tokenize_13a` of one text, for tasks that count its tokens anyway."""
    return _parts_13a(x.replace("<skipped>", "").replace("-\n", "").replace("\n", " "))


def _parts_13a(x: str) -> list[str]:
    if "&" in x:
        for old, new in R.TOK13A_ENTITIES:
            x = x.replace(old, new)
    x = f" {x} ".translate(_SINGLE)
    if "." in x or "," in x:
        for pattern, repl in _POINTS:
            x = pattern.sub(repl, x)
    if "-" in x:
        x = _HYPHENS[0].sub(_HYPHENS[1], x)
    return x.split()


class _Parts(dict):
    """Words met so far and their tokens."""

    def __missing__(self, word: str) -> list[str]:
        # no rule is about letters and digits alone
        self[word] = parts = [word] if word.isalnum() else _parts_13a(word)
        return parts


def tokens_13a(texts) -> list[list[str]]:
    """:func:`words_13a` of many texts. No rule looks across a space, so a word
    has the same tokens wherever it stands and is taken apart once."""
    parts = _Parts()
    words = (x.replace("<skipped>", "").replace("-\n", "").split() for x in texts)
    return [list(chain.from_iterable(map(parts.__getitem__, w))) for w in words]


def _ids(*sides) -> list[np.ndarray]:
    """Each side's items as integers that are equal where the items are."""
    ids: dict = {}
    return [np.fromiter((ids.setdefault(w, len(ids)) for w in side), np.int64, len(side)) for side in sides]


def gram_statistics(hyp: np.ndarray, ref: np.ndarray, order: int) -> list[tuple[int, int, int]]:
    """(matches, hyp grams, ref grams) for n = 1..order.

    Grams of n items are numbered exactly: each is (number of its first n - 1
    items, last item), renumbered from 0.
    """
    out, h, r = [], hyp, ref
    width = int(max(hyp.max(initial=0), ref.max(initial=0))) + 1
    for n in range(1, order + 1):
        if n > 1:
            h = h[:-1] * width + hyp[n - 1:] if len(h) else h
            r = r[:-1] * width + ref[n - 1:] if len(r) else r
        _, number = np.unique(np.concatenate([h, r]), return_inverse=True)
        size = int(number.max(initial=-1)) + 1
        both = np.minimum(np.bincount(number[:len(h)], minlength=size), np.bincount(number[len(h):], minlength=size))
        out.append((int(both.sum()), len(h), len(r)))
        h, r = number[:len(h)].astype(np.int64), number[len(h):].astype(np.int64)
    return out


#: items (of both sides) whose grams are counted together
GRAM_ITEMS = 1 << 16


def _numbered(sides) -> list[np.ndarray]:
    """Each side's items, of all its rows in turn, as small integers from 1 that are
    equal where the items are; the rows are lists of words, or texts."""
    if any(isinstance(row, str) for side in sides for row in side[:1]):
        points = [np.frombuffer("".join(side).encode("utf-32-le"), np.uint32) for side in sides]
        used = np.zeros(max(int(x.max(initial=0)) for x in points) + 1, np.int64)
        for x in points:
            used[x] = 1
        number = np.cumsum(used)
        return [number[x] for x in points]
    number = defaultdict(count(1).__next__)
    return [np.array([*map(number.__getitem__, chain.from_iterable(side))], np.int64) for side in sides]


def _gram_sums(hyps: list, refs: list, order: int) -> np.ndarray:
    """:func:`gram_statistics` of some rows: an array (row, order, 3).

    A gram is (row, items) in one number whose digits are the items, 0 behind a
    row's end. Grams that begin alike stand together once the longest are sorted,
    so one sort counts all orders; where not all items fit, the grams so far are
    numbered in their order and the next items are digits behind that."""
    sizes = [np.fromiter(map(len, side), np.int64, len(side)) for side in (hyps, refs)]
    items, at, grams = _numbered([hyps, refs]), [], []
    width, span = max(int(x.max(initial=0)) for x in items) + 1, len(hyps)
    for i, n in enumerate(sizes):
        row = np.repeat(np.arange(len(n)), n)
        at.append(np.arange(len(row)) + row * order)
        grams.append(row)
        spread = np.zeros(len(row) + len(n) * order, np.int64)
        spread[at[i]] = items[i]
        items[i] = spread
    out = np.zeros((len(hyps), order, 3), np.int64)
    for n in range(order):
        out[:, n, 1:] = np.maximum(np.stack(sizes, 1) - n, 0)
    rows, done = np.concatenate([[0], np.cumsum(sizes[0] + sizes[1])]), 0
    while done < order and rows[-1]:
        if done:
            seen, number = np.unique(np.concatenate(grams), return_inverse=True)
            grams, span = np.split(number, [len(grams[0])]), len(seen)
        first = done
        while done == first or done < order and span * width < 1 << 62:
            grams = [g * width + x[a + done] for g, x, a in zip(grams, items, at)]
            span, done = span * width, done + 1
        both = np.concatenate([grams[0] << 1, grams[1] << 1 | 1])
        both.sort()
        refs_before = np.concatenate([[0], np.cumsum(both & 1)])
        both >>= 1
        starts = np.arange(len(both))
        for n in range(done, first, -1):
            # shorter grams start where some longer ones do
            new = np.concatenate([[True], both[1:] != both[:-1]])
            both, starts = both[new], starts[new]
            ends = np.append(starts, rows[-1])
            of_ref = np.diff(refs_before[ends])
            shorter = both // width
            match = np.minimum(of_ref, np.diff(ends) - of_ref) * (both != shorter * width)
            # the first digit has the row, so rows stay in order
            out[:, n - 1, 0] = np.diff(np.concatenate([[0], np.cumsum(match)])[np.searchsorted(starts, rows)])
            both = shorter
    return out


def grams_of(hyps, refs, order: int) -> np.ndarray:
    """:func:`gram_statistics` of many segments at a time: an array (segment, order, 3)."""
    out, first, room = [np.zeros((0, order, 3), np.int64)], 0, GRAM_ITEMS
    for i, (h, r) in enumerate(zip(hyps, refs)):
        if (n := len(h) + len(r)) > room and i > first:
            out.append(_gram_sums(hyps[first:i], refs[first:i], order))
            first, room = i, GRAM_ITEMS
        room -= n
    if first < len(hyps):
        out.append(_gram_sums(hyps[first:], refs[first:], order))
    return np.concatenate(out)


def _places(words) -> dict:
    """For each word the places where it stands, as the bits of an integer."""
    at: dict = {}
    for i, w in enumerate(words):
        at[w] = at.get(w, 0) | 1 << i
    return at


def word_distance(ref: list, hyp: list, places: dict | None = None) -> int:
    """Levenshtein distance of two word lists, a column of the table at a time:
    the +1 and -1 steps down a column are the bits of two integers (Myers 1999).

    Words that both begin or end with cost nothing and stay out of the table.
    ``places`` are the :func:`_places` of ``ref``, where they are known.
    """
    n, m, a = len(ref), len(hyp), 0
    while a < n and a < m and ref[a] == hyp[a]:
        a += 1
    while n > a and m > a and ref[n - 1] == hyp[m - 1]:
        n, m = n - 1, m - 1
    if n == a or m == a:
        return n - a + m - a
    at, first = (_places(ref[a:n]), 0) if places is None else (places, a)
    n -= a
    full, top = (1 << n) - 1, 1 << n - 1
    up, down, score = full, 0, n
    for w in hyp[a:m]:
        eq = at.get(w, 0) >> first & full
        diag = ((eq & up) + up ^ up) | eq | down
        plus, minus = down | full & ~(diag | up), up & diag
        score += bool(plus & top) - bool(minus & top)
        plus, minus = (plus << 1 | 1) & full, minus << 1 & full
        step = eq | down
        up, down = minus | full & ~(step | plus), plus & step
    return score


# FIXED VALUES: the shift search of TER. Words of a block, places that it may
# move, and moved texts that are tried for a segment, all at most.
SHIFT_WORDS, SHIFT_PLACES, SHIFT_TRIALS = 10, 50, 1000
#: cells of the largest alignment table that is searched for shifts
SHIFT_CELLS = 1 << 26


def _alignment(ref: list, hyp: list, places: dict | None = None) -> tuple[list[int], list[int], list[int]]:
    """A cheapest alignment that prefers pairs, then words of the hypothesis
    alone: for each reference word the last hypothesis word at or before it
    (-1 for none), and running counts of the wrong words of both sides.

    The table is that of :func:`word_distance`, whole. Of a column two integers
    are kept: where a pair is a cheapest step (equal words, or a step of cost 1
    along the diagonal), and where the hypothesis word alone is one.
    """
    n, m = len(ref), len(hyp)
    at = _places(ref) if places is None else places
    full, kept = (1 << n) - 1, []
    up, down = full, 0
    for w in hyp:
        eq = at.get(w, 0)
        diag = ((eq & up) + up ^ up) | eq | down
        plus, minus = down | full & ~(diag | up), up & diag
        kept.append((eq | full & ~diag, plus))
        plus, minus = (plus << 1 | 1) & full, minus << 1 & full
        step = eq | down
        up, down = minus | full & ~(step | plus), plus & step
    before, wrong_ref, wrong_hyp = [-1] * n, [0] * (n + 1), [0] * (m + 1)
    i, j = m, n
    while i or j:
        pair, alone = kept[i - 1] if i and j else (0, not j)
        if pair and pair >> j - 1 & 1:
            wrong_ref[j] = wrong_hyp[i] = int(ref[j - 1] != hyp[i - 1])
            before[j - 1] = i - 1
            i, j = i - 1, j - 1
        elif alone and (not j or alone >> j - 1 & 1):
            wrong_hyp[i] = 1
            i -= 1
        else:
            wrong_ref[j] = 1
            before[j - 1] = i - 1
            j -= 1
    return before, [*accumulate(wrong_ref)], [*accumulate(wrong_hyp)]


def _moved(words: list, start: int, length: int, to: int) -> list:
    """``words`` with a block put before place ``to`` (places inside the block
    count from its end)."""
    block, rest = words[start:start + length], words[:start] + words[start + length:]
    at = to if to <= start else to - length if to > start + length else to
    return rest[:at] + block + rest[at:]


def _blocks(ref: list, hyp: list, wrong_ref: list[int], wrong_hyp: list[int]):
    """Equal runs as (place in hyp, place in ref, words), places near each other,
    that have a wrong word on both sides."""
    n, m = len(ref), len(hyp)
    places: dict = {}
    for j, w in enumerate(ref):
        # from here on only longer runs may have one, of SHIFT_WORDS at most
        if wrong_ref[min(j + SHIFT_WORDS, n)] > wrong_ref[j]:
            places.setdefault(w, []).append(j)
    for i, w in enumerate(hyp):
        if wrong_hyp[min(i + SHIFT_WORDS, m)] == wrong_hyp[i]:
            continue
        for j in places.get(w, ()):
            if abs(i - j) > SHIFT_PLACES:
                continue
            for length in range(1, SHIFT_WORDS + 1):
                if wrong_hyp[i + length] > wrong_hyp[i] and wrong_ref[j + length] > wrong_ref[j]:
                    yield i, j, length
                if i + length >= m or j + length >= n or hyp[i + length] != ref[j + length]:
                    break


def shifted_edits(ref: list, hyp: list) -> int:
    """Edits of TER: moves of blocks, found greedily, and the word distance left.

    Each round tries to move every block of the hypothesis that also stands in
    the reference, where words of both are wrong, next to the places that the
    alignment gives; the move that lowers the distance most is made (ties: the
    longest block, the first one, the first place). Distances are exact, without
    a beam. Segments of over 2^26 cells are rated without moves.
    """
    if not ref:
        return len(hyp)
    places = _places(ref)
    left, moves, trials = word_distance(ref, hyp, places), 0, 0
    while True:
        # a move is an edit and keeps the length, so the difference of lengths
        # stays; where it could save one edit only, nothing is won
        if left <= abs(len(ref) - len(hyp)) + 1 or len(ref) * len(hyp) > SHIFT_CELLS:
            return moves + left
        at, wrong_ref, wrong_hyp = _alignment(ref, hyp, places)
        best, most = None, left - abs(len(ref) - len(hyp))
        for i, j, length in _blocks(ref, hyp, wrong_ref, wrong_hyp):
            if i <= at[j] < i + length:
                continue
            last = None
            for k in range(j - 1, j + length):
                to = at[k] + 1 if k >= 0 else 0
                if to != last:
                    last = to
                    trials += 1
                    # moving a block can gain no more than taking it out and putting it in again
                    if best is not None and (min(2 * length, most), length, -i, -to) <= best[:4]:
                        continue
                    words = _moved(hyp, i, length, to)
                    tried = (left - word_distance(ref, words, places), length, -i, -to, words)
                    best = tried if best is None or tried > best else best
            if trials >= SHIFT_TRIALS:
                break
        if trials >= SHIFT_TRIALS or best is None or best[0] <= 0:
            return moves + left
        hyp, left, moves = best[-1], left - best[0], moves + 1


# statistics of a segment, by the metric that needs them
_GRAMS = {"bleu": BLEU_ORDER, "chrf": CHRF_ORDER}
_FIELDS = {
    **{m: [f"{m}_{c}{n}" for n in range(1, k + 1) for c in ("match", "hyp", "ref")] for m, k in _GRAMS.items()},
    "edits": ["dist", "ref_words", "hyp_words"],
    "edits_lower": ["low_dist", "low_ref_words"],
    "hits": ["hits"],
}


def _statistics(kinds):
    names = [c for k in kinds for c in _FIELDS[k]]

    @F.pandas_udf(", ".join(f"{c} long" for c in names))
    def stats(hyp: pd.Series, ref: pd.Series) -> pd.DataFrame:
        parts = []
        if "hits" in kinds:  # the table of the hits has the word distances too
            words = [[x.split() for x in side] for side in (ref, hyp)]
            aligned = edits_of(*words)
        for k in kinds:
            if k == "bleu":
                tokens = tokens_13a([*hyp, *ref])
                parts.append(grams_of(tokens[:len(hyp)], tokens[len(hyp):], BLEU_ORDER))
            elif k == "chrf":
                sums = grams_of(["".join(x.split()) for x in hyp], ["".join(x.split()) for x in ref], CHRF_ORDER)
                # an order that the reference does not have counts no hypothesis grams
                sums[:, :, 1] *= sums[:, :, 2] > 0
                parts.append(sums)
            elif k == "edits_lower":
                pairs = ((r.lower().split(), h.lower().split()) for h, r in zip(hyp, ref))
                parts.append([(shifted_edits(r, h), len(r)) for r, h in pairs])
            elif k == "hits":
                parts.append(aligned[:, 1])
            elif "hits" in kinds:
                parts.append(np.stack([aligned[:, 0], *([*map(len, side)] for side in words)], 1))
            else:
                pairs = ((r.split(), h.split()) for h, r in zip(hyp, ref))
                parts.append([(word_distance(r, h), len(r), len(h)) for r, h in pairs])
        rows = np.concatenate([np.asarray(x, np.int64).reshape(len(hyp), len(_FIELDS[k])) for x, k in zip(parts, kinds)], 1)
        return pd.DataFrame(rows, columns=names, dtype="int64")

    return stats, names


def segment_sums(df: DataFrame, keys, kinds) -> DataFrame:
    """Sums of the segments' statistics per key: one projection, one aggregate.

    A null side counts as empty text. The tasks get each text once and take it
    apart themselves: ``str.split`` splits like :func:`_ws_split`.
    """
    stats, names = _statistics(kinds)
    hyp, ref = (F.coalesce(F.col(c), F.lit("")) for c in ("hyp", "ref"))
    t = df.select(*keys, stats(hyp, ref).alias("_s"))
    return t.groupBy(*keys).agg(*(F.coalesce(F.sum(f"_s.{c}"), F.lit(0)).cast("double").alias(c) for c in names))


def _bleu_score() -> tuple[Column, Column, Column]:
    log_sum, zeros = F.lit(0.0), F.lit(0)
    for n in range(1, BLEU_ORDER + 1):
        c, t = F.col(f"bleu_match{n}"), F.col(f"bleu_hyp{n}")
        zeros = zeros + F.when(c == 0, 1).otherwise(0)
        p = F.when(c == 0, F.try_divide(F.lit(100.0), F.pow(F.lit(2.0), zeros) * t)).otherwise(F.try_divide(F.lit(100.0) * c, t))
        log_sum = log_sum + F.log(p)
    sys_len, ref_len = F.col("bleu_hyp1"), F.col("bleu_ref1")  # tokens are the grams of order 1
    bp = (F.when(sys_len >= ref_len, F.lit(1.0)).when(sys_len > 0, F.exp(F.lit(1.0) - F.try_divide(ref_len, sys_len)))
          .otherwise(F.lit(0.0)))
    score = F.when(F.col(f"bleu_hyp{BLEU_ORDER}") == 0, F.lit(0.0)).otherwise(bp * F.exp(log_sum / BLEU_ORDER))
    return score, sys_len, ref_len


def _chrf_score() -> Column:
    prec_sum, rec_sum, eff = F.lit(0.0), F.lit(0.0), F.lit(0)
    for n in range(1, CHRF_ORDER + 1):
        hn, rn, mn = F.col(f"chrf_hyp{n}"), F.col(f"chrf_ref{n}"), F.col(f"chrf_match{n}")
        both = (hn > 0) & (rn > 0)
        prec_sum = prec_sum + F.when(both, F.try_divide(mn, hn)).otherwise(0.0)
        rec_sum = rec_sum + F.when(both, F.try_divide(mn, rn)).otherwise(0.0)
        eff = eff + F.when(both, 1).otherwise(0)
    ap, ar = F.coalesce(F.try_divide(prec_sum, eff), F.lit(0.0)), F.coalesce(F.try_divide(rec_sum, eff), F.lit(0.0))
    f = F.lit(CHRF_BETA ** 2)
    return F.coalesce(F.try_divide(F.lit(100.0) * (1 + f) * ap * ar, f * ap + ar), F.lit(0.0))


def _wer_score() -> Column:
    return F.try_divide(F.col("dist"), F.col("ref_words"))


def _edit_rate_score() -> Column:
    return F.try_divide(F.lit(100.0) * F.col("low_dist"), F.col("low_ref_words"))


def _mer_score() -> Column:
    return F.try_divide(F.col("dist"), F.col("hits") + F.col("dist"))


def _wil_score() -> Column:
    return F.lit(1.0) - F.try_divide(F.col("hits"), F.col("ref_words")) * F.try_divide(F.col("hits"), F.col("hyp_words"))


def bleu(df: DataFrame, keys=()) -> DataFrame:
    """MET1: corpus BLEU per key (0-100), sacreBLEU defaults."""
    score, sys_len, ref_len = _bleu_score()
    return segment_sums(df, list(keys), ["bleu"]).select(*keys, score.alias("bleu"), sys_len.alias("sys_len"), ref_len.alias("ref_len"))


def chrf(df: DataFrame, keys=()) -> DataFrame:
    """MET2: corpus chrF per key (0-100): char 1-6 grams, beta 2, no spaces."""
    return segment_sums(df, list(keys), ["chrf"]).select(*keys, _chrf_score().alias("chrf"))


def wer(df: DataFrame, keys=()) -> DataFrame:
    """MET4: WER = sum of word edit distances / sum of reference words."""
    return segment_sums(df, list(keys), ["edits"]).select(*keys, _wer_score().alias("wer"))


def edit_rate(df: DataFrame, keys=()) -> DataFrame:
    """MET3: TER, moves of blocks included (case-insensitive, x100), per key."""
    return segment_sums(df, list(keys), ["edits_lower"]).select(*keys, _edit_rate_score().alias("edit_rate"))


_KEY = 1 << 31  # (cost, hits) packed as cost * _KEY - hits: one integer, min = best; hits are fewer than words


def _weights(key: int) -> tuple[int, int]:
    """What pairs of equal and of other words save, in an alignment that starts
    from all words of both sides alone, one edit each: the heaviest alignment has
    the least cost and, of those, the most hits."""
    return 2 * key + 1, key


def _cost_and_hits(words, saved, key: int):
    rest = words * key - saved
    cost = -(-rest // key)
    return cost, cost * key - rest


def alignment(ref_words, hyp_words) -> tuple[int, int]:
    """Cost of a cheapest word alignment, and its hits, most hits among ties.

    Row by row in numpy: an alignment goes on from the row before, with a pair or
    without one, or within the row, one ``maximum.accumulate``.
    """
    n, m = len(ref_words), len(hyp_words)
    number = defaultdict(count().__next__)
    a, b = (np.array([*map(number.__getitem__, side)], np.int64) for side in (ref_words, hyp_words))
    same, other = _weights(_KEY)
    saved, new = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    for w in a:
        np.add(saved[:-1], np.where(b == w, same, other), out=new[1:])
        np.maximum(new, saved, out=new)
        np.maximum.accumulate(new, out=saved)
    return _cost_and_hits(n + m, int(saved[m]), _KEY)


def alignment_hits(ref_words, hyp_words) -> int:
    """Hits of a minimum-cost word alignment, most hits among ties."""
    return alignment(ref_words, hyp_words)[1]


#: words of both sides, and cells, of the tables that are filled together
HITS_WORDS, HITS_CELLS = 1 << 14, 1 << 18
_SMALL_KEY = 1 << 15


def edits_of(refs, hyps) -> np.ndarray:
    """:func:`alignment` of many segments: an array (segment, 2). Words that both
    sides begin or end with are hits of some best alignment; the tables of the
    rest are filled together, those of like size at a time."""
    out, rest = np.zeros((len(refs), 2), np.int64), []
    for k, (r, h) in enumerate(zip(refs, hyps)):
        n, m = len(r), len(h)
        a = 0
        while a < n and a < m and r[a] == h[a]:
            a += 1
        while n > a and m > a and r[n - 1] == h[m - 1]:
            n, m = n - 1, m - 1
        out[k] = n + m - 2 * a, a + len(r) - n
        if n > a and m > a:
            rest.append((n - a, m - a, k, a))
    rest.sort()
    group, cells = [], 0
    for x in rest:
        n, m, k, a = x
        if n + m >= HITS_WORDS or n * m > HITS_CELLS:
            cost, hits = alignment(refs[k][a:a + n], hyps[k][a:a + m])
            out[k] = cost, out[k, 1] + hits
            continue
        # the next is the longest, but may be narrower
        wide = max(max((y[1] for y in group[:1]), default=0), cells, m)
        if group and (len(group) + 1) * n * wide > HITS_CELLS:
            _fill(group, refs, hyps, out)
            group, wide = [], m
        group.append(x)
        cells = wide
    if group:
        _fill(group, refs, hyps, out)
    return out


def hits_of(refs, hyps) -> list[int]:
    """:func:`alignment_hits` of many segments."""
    return edits_of(refs, hyps)[:, 1].tolist()


def _fill(group, refs, hyps, out) -> None:
    """Set the costs, and add the hits, of the words ``(n, m, segment, first word)`` in ``out``."""
    number = defaultdict(count().__next__)
    rows, columns, segments, _ = np.array(group).T
    n, m = int(rows[-1]), int(columns.max())
    ref, hyp = np.full((n, len(group)), -1, np.int32), np.full((m, len(group)), -2, np.int32)
    for i, (p, q, k, a) in enumerate(group):
        ref[:p, i] = [*map(number.__getitem__, refs[k][a:a + p])]
        hyp[:q, i] = [*map(number.__getitem__, hyps[k][a:a + q])]
    same, other = map(np.int32, _weights(_SMALL_KEY))
    # the longest come last: those of up to i words end before ended[i]
    ended = np.searchsorted(rows, np.arange(n + 1), "right")
    saved, new = np.zeros((2, m + 1, len(group)), np.int32)
    best = np.zeros(len(group), np.int64)
    for i in range(1, n + 1):
        np.add(saved[:-1], np.where(hyp == ref[i - 1], same, other), out=new[1:])
        np.maximum(new, saved, out=new)
        np.maximum.accumulate(new, axis=0, out=saved)
        if ended[i] > ended[i - 1]:
            some = np.arange(ended[i - 1], ended[i])
            best[some] = saved[columns[some], some]
    cost, hits = _cost_and_hits(rows + columns, best, _SMALL_KEY)
    out[segments, 0] = cost
    out[segments, 1] += hits


def mer_wil(df: DataFrame, keys=()) -> DataFrame:
    """MET5: MER = E/(H+E) and WIL = 1 - (H/N)(H/M), summed over segments.

    E is the word edit distance, H the hits of an optimal alignment.
    """
    return segment_sums(df, list(keys), ["edits", "hits"]).select(*keys, _mer_score().alias("mer"), _wil_score().alias("wil"))


def score(df: DataFrame, keys=()) -> DataFrame:
    """MET6: all metrics as a long table ``(*keys, metric, score)``, from one scan."""
    scores = {"BLEU": _bleu_score()[0], "CHRF": _chrf_score(), "TER": _edit_rate_score(), "WER": _wer_score(),
              "MER": _mer_score(), "WIL": _wil_score()}
    sums = segment_sums(df, list(keys), list(_FIELDS))
    rows = F.array(*(F.struct(F.lit(m).alias("metric"), c.alias("score")) for m, c in scores.items()))
    return sums.select(*keys, F.inline(rows))
