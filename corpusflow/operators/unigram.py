"""Unigram subword vocabulary (VOC2) and its encoder (VOC3), after Kudo (2018).

Words are counted once; every pass of the training runs over that table of
distinct words. Seed pieces are the substrings of words that weigh most by
frequency times length. A pass sends the pieces and their log probabilities to
the tasks (their number is a parameter, whatever the corpus), a task runs
forward and backward over the lattices of a batch of words side by side and adds
up expected counts by piece, and one aggregate over (piece, count) rows ends it. Between passes
the pieces whose loss costs the least likelihood go, a quarter at a time, until
the size is reached. Encoding is one projection of the texts: no word becomes a
row, so no word can be hot.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.vocab import EOS_ID, UNK_ID, WORD_START, _written, word_counts

#: characters of a piece at most
LONGEST = 16
#: pieces that stay in a pruning, passes of expectation and maximisation before it
KEEP, PASSES = 0.75, 2
#: expected count below which a piece of several characters goes
LEAST = 0.5
#: how much less likely than the least likely piece an unknown character is (log)
UNKNOWN = 10.0
#: characters up to which words are taken side by side, a step for each position, and of all those words
SIDE_BY_SIDE, TOGETHER = 256, 100_000
#: segmented words kept in one Python worker
WORDS_KEPT = 200_000


def seed_pieces(words: DataFrame, n: int) -> DataFrame:
    """``piece, freq``: all characters of ``words(word, cnt)`` (a word begins with
    the word mark), and the ``n`` substrings of 2 to 16 characters met at least
    twice with most frequency times length (ties by piece)."""
    marked = words.select(F.concat(F.lit(WORD_START), "word").alias("w"), "cnt")
    size = F.length("w")
    parts = F.flatten(F.transform(F.sequence(F.lit(1), size), lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(LONGEST), size - i + 1)), lambda m: F.substr(F.col("w"), i, m))))
    counts = marked.select(F.explode(parts).alias("piece"), "cnt").groupBy("piece").agg(F.sum("cnt").alias("freq"))
    # most substrings occur once; nothing below asks for them
    counts = _written(counts.where((F.length("piece") == 1) | (F.col("freq") > 1)))
    long = counts.where((F.length("piece") > 1) & (F.col("freq") > 1))
    best = long.orderBy((F.col("freq") * F.length("piece")).desc(), "piece").limit(n)
    return counts.where(F.length("piece") == 1).unionByName(best)


class Model:
    """Log probabilities of pieces, and lattices of words over them."""

    def __init__(self, pieces: list[str], scores):
        self.pieces, self.scores = list(pieces), [float(s) for s in scores]
        self.at = {p: i for i, p in enumerate(self.pieces)}
        self.longest = max(map(len, self.pieces), default=1)
        self.unknown = min(self.scores, default=0.0) - UNKNOWN

    def edges(self, word: str) -> list[list[tuple[int, int]]]:
        """For each end, the (start, piece) of all pieces that end there; -1 for
        a character that is no piece."""
        out: list[list[tuple[int, int]]] = [[] for _ in range(len(word) + 1)]
        for start in range(len(word)):
            for end in range(start + 1, min(len(word), start + self.longest) + 1):
                i = self.at.get(word[start:end])
                if i is not None:
                    out[end].append((start, i))
                elif end == start + 1:
                    out[end].append((start, -1))
        return out

    def score(self, i: int) -> float:
        return self.scores[i] if i >= 0 else self.unknown

    def best(self, word: str, without: int | None = None) -> list[tuple[int, int, int]]:
        """Likeliest segmentation as (start, end, piece); of equally likely ones
        that whose last piece is longer. ``without`` is a piece not to use."""
        score, back = [0.0] + [-math.inf] * len(word), [(0, -1)] * (len(word) + 1)
        for end, into in enumerate(self.edges(word)):
            for start, i in into:
                if (i != without or i < 0) and (s := score[start] + self.score(i)) > score[end]:
                    score[end], back[end] = s, (start, i)
        out, end = [], len(word)
        while end:
            start, i = back[end]
            out.append((start, end, i))
            end = start
        return out[::-1]

    def expect(self, word: str, times: float, into: dict[int, float]) -> float:
        """Add the expected counts of pieces in ``times`` words; returns the log likelihood of one."""
        edges = self.edges(word)
        ahead = [0.0] * len(edges)
        for end in range(1, len(edges)):
            ahead[end] = _log_sum([ahead[s] + self.score(i) for s, i in edges[end]])
        behind = [-math.inf] * len(edges)
        behind[-1] = 0.0
        for end in range(len(edges) - 1, 0, -1):
            for s, i in edges[end]:
                through = behind[end] + self.score(i)
                behind[s] = _log_sum([behind[s], through])
                if i >= 0:
                    p = math.exp(ahead[s] + through - ahead[-1])
                    into[i] = into.get(i, 0.0) + p * times
        return ahead[-1]


class Lattices:
    """The lattices of many ``words`` side by side: an arc for each piece that
    stands somewhere in one, and for each character that is no piece (-1)."""

    def __init__(self, trie: "Trie", words: list[str]):
        n = np.fromiter(map(len, words), np.int64, len(words))
        points = np.array(memoryview("".join(words).encode("utf-32-le")).cast("I"), np.int64)
        word = np.repeat(np.arange(len(words)), n)
        # a word has a place before each character and one at its end
        first = np.cumsum(n + 1) - (n + 1)
        self.end, self.places = first + n, int((n + 1).sum())
        place = np.arange(len(points)) + word
        start, stop, piece = trie.found(points, np.repeat(np.cumsum(n), n))
        self.word, self.piece = word[start], piece
        self.start, self.stop = place[start], place[start] + stop - start
        # arcs by where they end, those from further left first, and by where they start
        self.ends = self._steps(self.stop - first[self.word], self.stop, self.start)
        self.starts = self._steps(self.start - first[self.word], self.start, self.stop)[::-1]

    @staticmethod
    def _steps(at, place, other) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each position in the words: its arcs, grouped by place; where groups begin; the arcs' groups."""
        order = np.lexsort((other, place, at))
        cuts = np.flatnonzero(np.diff(at[order])) + 1
        steps = []
        for arcs in np.split(order, cuts) if len(order) else []:
            new = np.diff(place[arcs], prepend=-1) != 0
            steps.append((arcs, np.flatnonzero(new), np.cumsum(new) - 1))
        return steps

    def expect(self, scores: np.ndarray, times: np.ndarray, into: np.ndarray) -> np.ndarray:
        """As ``Model.expect`` for each word; ``scores`` has that of unknown characters last."""
        arc = scores[self.piece]
        ahead, behind = np.zeros(self.places), np.zeros(self.places)
        for steps, to, goal, other in ((self.ends, ahead, self.stop, self.start), (self.starts, behind, self.start, self.stop)):
            for arcs, first, group in steps:
                v = to[other[arcs]] + arc[arcs]
                top = np.maximum.reduceat(v, first)
                to[goal[arcs[first]]] = top + np.log(np.add.reduceat(np.exp(v - top[group]), first))
        whole = ahead[self.end]
        known = self.piece >= 0
        p = np.exp(ahead[self.start] + arc + behind[self.stop] - whole[self.word]) * times[self.word]
        into += np.bincount(self.piece[known], p[known], len(into))
        return whole

    def best(self, scores: np.ndarray, times: np.ndarray, into: np.ndarray) -> None:
        """Add the ``times`` of words to the pieces of their likeliest segmentations (``Model.best``)."""
        arc = scores[self.piece]
        ahead, back = np.zeros(self.places), np.full(self.places, -1)
        for arcs, first, group in self.ends:
            v = ahead[self.start[arcs]] + arc[arcs]
            top = np.maximum.reduceat(v, first)
            ahead[self.stop[arcs[first]]] = top
            # of equally likely ones the longer piece, which comes first
            likeliest = np.flatnonzero(v == top[group])[::-1]
            back[self.stop[arcs[likeliest]]] = arcs[likeliest]
        arcs = back[self.end]
        while len(arcs := arcs[arcs >= 0]):
            known = arcs[self.piece[arcs] >= 0]
            into += np.bincount(self.piece[known], times[self.word[known]], len(into))
            arcs = back[self.start[arcs]]


class Trie:
    """Finds all pieces in texts, one more character of all places at a time."""

    def __init__(self, pieces: list[str]):
        self.chars = np.array(sorted({ord(c) for p in pieces for c in p}), np.int64)
        code = {chr(c): i for i, c in enumerate(self.chars.tolist())}
        nodes, at = {}, {}
        for i, p in enumerate(pieces):
            node = 0
            for c in p:
                node = nodes.setdefault(node * len(code) + code[c], len(nodes) + 1)
            at[node] = i
        self.keys = np.array(sorted(nodes), np.int64)
        self.next = np.array([nodes[k] for k in self.keys.tolist()], np.int64)
        self.piece = np.array([at.get(n, -1) for n in range(len(nodes) + 1)], np.int64)

    def found(self, points: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of the pieces in ``points``, none over the ends
        ``until`` of its word; -1 for a character that is no piece."""
        code = np.searchsorted(self.chars, points)
        code[np.append(self.chars, -1)[code] != points] = -1
        start, node, n, out = np.arange(len(points)), np.zeros(len(points), np.int64), 0, []
        while len(start):
            c = code[start + n]
            key = node * len(self.chars) + c
            at = np.searchsorted(self.keys, key)
            on = (c >= 0) & (np.append(self.keys, -1)[at] == key)
            node = np.where(on, np.append(self.next, 0)[at], 0)
            piece = np.where(on, self.piece[node], -1)
            n += 1
            some = piece >= 0 if n > 1 else np.ones(len(start), bool)
            out.append((start[some], start[some] + n, piece[some]))
            on &= start + n < until[start]
            start, node = start[on], node[on]
        return tuple(np.concatenate(x) for x in zip(*out)) if out else tuple(np.zeros(0, np.int64) for _ in range(3))


def _log_sum(x: list[float]) -> float:
    top = max(x, default=-math.inf)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in x))


def digamma(x: float) -> float:
    """Derivative of log gamma for x > 0."""
    out = 0.0
    while x < 8:
        out -= 1 / x
        x += 1
    y = 1 / (x * x)
    return out + math.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def _by_piece(words: DataFrame, model: Model, many: Callable, one: Callable) -> tuple[dict[str, float], float]:
    """Sums by piece over ``words(word, cnt)``, and the sum of the log likelihoods returned.

    ``many(lattices, scores, times, sums)`` takes words side by side, ``one(model,
    word, times, sums)`` one of the long ones; both return log likelihoods or None.
    """
    shared = words.sparkSession.sparkContext.broadcast((model.pieces, model.scores))

    def run(batches):
        own = Model(*shared.value)
        trie, scores = Trie(own.pieces), np.array([*own.scores, own.unknown])
        sums, met, total = np.zeros(len(own.pieces)), np.zeros(len(own.pieces), bool), 0.0
        for b in batches:
            marked = [WORD_START + w for w in b.column("word").to_pylist()]
            times = b.column("cnt").to_numpy(zero_copy_only=False).astype(float)
            size = np.fromiter(map(len, marked), np.int64, len(marked))
            short = np.flatnonzero(size <= SIDE_BY_SIDE)
            for few in np.split(short, np.flatnonzero(np.diff(np.cumsum(size[short]) // TOGETHER)) + 1):
                lattices = Lattices(trie, [marked[i] for i in few])
                met[lattices.piece[lattices.piece >= 0]] = True
                said = many(lattices, scores, times[few], sums)
                total += 0.0 if said is None else float(said @ times[few])
            for i in np.flatnonzero(size > SIDE_BY_SIDE):
                found: dict[int, float] = {}
                total += (one(own, marked[i], times[i], found) or 0.0) * times[i]
                for k, v in found.items():
                    sums[k] += v
                    met[k] = True
        ids = np.flatnonzero(met)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *ids.tolist()], pa.int64()), pa.array([total, *sums[ids].tolist()], pa.float64())], names=["i", "v"])

    rows = words.select("word", "cnt").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v"))
    # no more rows than pieces
    found = {r.i: r.v for r in rows.collect()}
    total = found.pop(-1, 0.0)
    return {model.pieces[i]: v for i, v in found.items()}, total


def expected_counts(words: DataFrame, model: Model) -> tuple[dict[str, float], float]:
    """Expected count of each piece and log likelihood of ``words(word, cnt)``."""
    return _by_piece(words, model, lambda lattices, *x: lattices.expect(*x), lambda m, *x: m.expect(*x))


def best_counts(words: DataFrame, model: Model) -> dict[str, float]:
    """Count of each piece in the likeliest segmentations."""
    def one(m, word, times, sums):
        for *_, i in m.best(word):
            if i >= 0:
                sums[i] = sums.get(i, 0.0) + times

    found, _ = _by_piece(words, model, lambda lattices, *x: lattices.best(*x), one)
    return {p: n for p, n in found.items() if n}


def maximised(counts: dict[str, float], chars) -> Model:
    """The model of expected counts. Characters stay; other pieces under ``LEAST`` go."""
    kept = {p: max(round(c, 9), LEAST) for p, c in counts.items() if c >= LEAST or len(p) == 1}
    kept |= {c: LEAST for c in chars if c not in kept}
    total = digamma(sum(kept.values()))
    pieces = sorted(kept)
    return Model(pieces, [digamma(kept[p]) - total for p in pieces])


def pruned(model: Model, counts: dict[str, float], size: int) -> Model:
    """The ``size`` pieces, all characters among them, without which the
    likelihood of the likeliest segmentations (``counts``) would fall most."""
    total = sum(counts.values())
    loss: dict[str, float] = {}
    for i, p in enumerate(model.pieces):
        if len(p) == 1:
            loss[p] = math.inf
            continue
        f = counts.get(p, 0.0)
        if not f or [x for *_, x in model.best(p)] != [i]:
            continue
        instead = [model.pieces[x] for *_, x in model.best(p, without=i)]
        after = math.log(total + f * (len(instead) - 1))
        loss[p] = f / total * (math.log(f / total) - sum(math.log(counts.get(x, 0.0) + f) - after for x in instead))
    kept = sorted(loss, key=lambda p: (-loss[p], p))
    kept = sorted(kept[:max(size, sum(len(p) == 1 for p in kept))])
    return Model(kept, [model.scores[model.at[p]] for p in kept])


def train(df: DataFrame, size: int = 8000, seeds: int | None = None, text: str = "text") -> tuple[DataFrame, Model, list[float]]:
    """VOC2: (vocabulary ``piece, id, score``; its model; log likelihood at each pass).

    ``size`` pieces, two of them special (ids: eos = 0, unk = 1, no bos), full
    character coverage: all characters of the corpus are pieces, also beyond
    ``size``. ``seeds`` bounds the pieces of the first pass (ten times the size
    by default) and with it what the driver and a task hold. An empty corpus
    gives the special pieces only; null texts count as empty.
    """
    words = _written(word_counts(df.where(F.col(text).isNotNull()), text))
    first = {r.piece: r.freq * len(r.piece) for r in seed_pieces(words, seeds or 10 * size).collect()}
    chars = [p for p in first if len(p) == 1]
    total = math.log(sum(first.values())) if first else 0.0
    pieces = sorted(first)
    model, said = Model(pieces, [math.log(first[p]) - total for p in pieces]), []
    room = max(size - 2, len(chars))
    goal = int(1.1 * room)
    while model.pieces:
        for _ in range(PASSES):
            counts, likelihood = expected_counts(words, model)
            said.append(likelihood)
            model = maximised(counts, chars)
        if len(model.pieces) <= goal:
            break
        model = pruned(model, best_counts(words, model), max(goal, int(KEEP * len(model.pieces))))
    # characters first, then the likeliest
    order = sorted(zip(model.pieces, model.scores), key=lambda x: (len(x[0]) > 1, -x[1], x[0]))[:room]
    order.sort(key=lambda x: (-x[1], x[0]))
    model = Model([p for p, _ in order], [s for _, s in order])
    rows = [("</s>", EOS_ID, 0.0), ("<unk>", UNK_ID, 0.0), *((p, i + 2, s) for i, (p, s) in enumerate(order))]
    return df.sparkSession.createDataFrame(rows, "piece string, id long, score double"), model, said


def encode(df: DataFrame, model: Model, keys, text: str = "text") -> DataFrame:
    """VOC3: ``keys, pieces`` by the likeliest segmentation of each word.

    Characters that are no piece stand for themselves. Null and empty texts
    have no pieces. The model is broadcast, its size is the vocabulary's.
    """
    shared = df.sparkSession.sparkContext.broadcast((model.pieces, model.scores))
    words = F.filter(F.split(F.trim(F.coalesce(F.col(text), F.lit(""))), r"\s+"), lambda w: w != "")
    inputs = df.select(*keys, words.alias("pieces"))

    def run(batches):
        own, known = Model(*shared.value), {}
        for b in batches:
            if len(known) > WORDS_KEPT:
                known.clear()
            out = []
            for row in b.column("pieces").to_pylist():
                for w in set(row).difference(known):
                    marked = WORD_START + w
                    known[w] = [marked[s:e] for s, e, _ in own.best(marked)]
                out.append([p for w in row for p in known[w]])
            at = b.schema.get_field_index("pieces")
            yield b.set_column(at, b.schema.field(at), pa.array(out, b.schema.field(at).type))

    return inputs.mapInArrow(run, inputs.schema)


def decode(pieces) -> F.Column:
    """Text of an array of pieces: words parted by single spaces."""
    return F.trim(F.replace(F.array_join(pieces, ""), F.lit(WORD_START), F.lit(" ")))
