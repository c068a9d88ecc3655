"""Mixing sources to target weights by Pfair scheduling (operator 5).

Documents of a source form blocks. A source with weight w gives its block j
the release slot floor(j / w) and the deadline ceil((j + 1) / w); among the
released blocks, the one with the earliest deadline takes the next slot. With
weights that are whole numbers the schedule repeats after as many slots as
their sum, so one period is worked out (running counts over its blocks and
slots, parted by deadline) and the slot of any block follows from its number alone. In every prefix of the balanced part
each source is less than one block away from its share of the period.

DataFrame functions only.
"""

from __future__ import annotations

import math
from fractions import Fraction
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corpusflow.llm.common import read, written

#: whole parts that weights from counts are rounded to; as many times that as four for each source need
PARTS = 1000
#: slots of the longest period for given weights (a period is four slots a source at least)
MOST = 1 << 20
#: ways in which blocks and slots of a period are parted at a time
WAYS = 16
#: documents in a block
BLOCK = 8
#: weight of a source without one given: its number of documents to this power
FLATTEN = 0.5
#: groups that a source's documents are dealt to while they are numbered
DEALS = 4096


def source_key() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def _deal() -> Column:
    digits = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 3)
    return F.conv(digits, 16, 10).cast("int")


def _whole(weights: dict[str, float]) -> dict[str, int] | None:
    """The weights as whole numbers in the same proportions, or None where they sum to more than ``MOST``."""
    exact = {k: max(Fraction(str(v)), Fraction(0)) for k, v in weights.items()}
    unit = math.lcm(*(v.denominator for v in exact.values()))
    whole = {k: int(v * unit) for k, v in exact.items()}
    shared = math.gcd(*whole.values()) or 1
    return {k: v // shared for k, v in whole.items()} if sum(whole.values()) // shared <= MOST else None


def _lookup(table: dict) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), F.col("source"))


def quotas(counts: DataFrame, weights: dict[str, float] | None, block: int) -> DataFrame:
    """``rank, source, quota, parts, weighed, base, end``: of every ``parts`` slots
    from ``base`` on, ``quota`` are the source's; ``end`` is the first slot for
    which some source may have no block left.

    ``counts(source, n_docs)``. Sources in ``weights`` get theirs: exactly, in a
    period of their sum in whole numbers, where that is ``MOST`` at most, else by
    largest remainder in as many parts as there are blocks (up to ``MOST``, and
    four for each source), with one part where a weight above 0 would get none.
    Sources of weight 0 or less, or not in ``weights``, have no share: they are
    not ``weighed`` and take turns after the last block of those that are.

    Without ``weights`` a source weighs its count to the power ``FLATTEN``. There
    are as many times ``PARTS`` parts as four for each source need; each source
    gets one and the rest go by largest remainder.
    """
    every = W.partitionBy(F.lit(0))
    blocks = F.ceil(F.col("n_docs") / block)
    whole = _whole(weights) if weights else None
    if weights is None:
        w = F.pow(F.col("n_docs").cast("double"), F.lit(FLATTEN))
    else:
        w = F.greatest(F.coalesce(_lookup({k: float(v) for k, v in weights.items()}), F.lit(0.0)), F.lit(0.0)) \
            if weights else F.lit(0.0)
    named = counts.withColumn("w", w).withColumn("weighed", F.col("w") > 0)
    group = W.partitionBy("weighed")
    n = F.count(F.lit(1)).over(group)
    if weights is None:
        least, parts = 1, F.ceil(4 * n / PARTS) * PARTS
    else:
        least, parts = 0, F.greatest(F.lit(PARTS), 4 * n, F.least(F.sum(blocks).over(every), F.lit(MOST)))
    named = named.withColumn("least", F.lit(least).cast("long")).withColumn("all", parts.cast("long"))
    spare = F.col("all") - F.col("least") * n
    share = spare * F.col("w") / F.sum("w").over(group)
    # remainders are compared at six digits, so that ties are ties on any engine
    parts = (named.withColumn("spare", spare).withColumn("share", F.when(F.col("weighed"), share).otherwise(0.0))
             .withColumn("whole", F.floor(F.round("share", 6))).withColumn("left", F.round(F.col("share") - F.col("whole"), 6)))
    order = group.orderBy(F.desc("left"), "source")
    more = (F.row_number().over(order) <= F.col("spare") - F.sum("whole").over(group)).cast("long")
    quota = F.greatest(F.col("whole") + F.col("least") + more, F.lit(1))
    if whole:
        quota = F.coalesce(_lookup(whole), F.lit(1)).cast("long")
    given = (parts.withColumn("quota", F.when(F.col("weighed"), quota).otherwise(1).cast("long"))
             .withColumn("parts", F.sum("quota").over(group)))
    lasts = F.floor(blocks * F.col("parts") / F.col("quota"))
    done = F.max(F.when(F.col("weighed"), F.ceil(blocks * F.col("parts") / F.col("quota")))).over(every)
    end = F.coalesce(F.min(F.when(F.col("weighed"), lasts)).over(every), F.min(lasts).over(every))
    return given.select((F.row_number().over(every.orderBy("source")) - 1).alias("rank"), "source", "quota", "parts", "weighed",
                        F.when(F.col("weighed"), 0).otherwise(F.coalesce(done, F.lit(0))).cast("long").alias("base"),
                        end.alias("end"))


def _level(rows: DataFrame, below: int) -> DataFrame:
    """One digit more of ``node`` for all jobs and slots.

    A job's digit comes from its priority. Jobs with a digit under ``k`` never
    wait for others, so a slot is left over by them just where the running
    count of such jobs less that of slots falls to a new low: the slot's digit
    is the number of ``k`` that leave it over.
    """
    digit = F.floor(F.col("priority") / below) % WAYS
    order = W.partitionBy("weighed", "node").orderBy("time", "is_slot")
    upto, before = order.rowsBetween(W.unboundedPreceding, 0), order.rowsBetween(W.unboundedPreceding, -1)
    ks = range(1, WAYS)
    step = lambda k: F.when(F.col("is_slot"), -1).when(digit < k, 1).otherwise(0)
    rows = rows.withColumns({f"n{k}": F.sum(step(k)).over(upto) for k in ks})
    rows = rows.withColumns({f"low{k}": F.least(F.min(f"n{k}").over(before), F.lit(0)) for k in ks})
    left = reduce(add, ((F.col(f"n{k}") < F.col(f"low{k}")).cast("long") for k in ks))
    return rows.withColumn("node", F.col("node") * WAYS + F.when(F.col("is_slot"), left).otherwise(digit)).drop(
        *(f"{c}{k}" for c in ("n", "low") for k in ks))


def period(quota: DataFrame, slots: int) -> DataFrame:
    """``source, quota, parts, base, end, slots``: the slots of each source's blocks
    in the first period, which has ``slots`` slots at most.

    The blocks of a period are jobs of one slot with a fixed priority (deadline,
    then rank). Jobs and slots are parted by priority, ``WAYS`` ways at a time,
    until each job is alone with its slot; a level is one shuffle and running
    counts, whatever the number of sources and quotas.
    """
    turn, q, parts = F.col("turn"), F.col("quota"), F.col("parts")
    jobs = quota.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), q - 1)))
    jobs = jobs.select("weighed", "rank", "turn", F.floor(turn * parts / q).alias("time"),
                       (F.row_number().over(W.partitionBy("weighed").orderBy(F.ceil((turn + 1) * parts / q), "rank")) - 1)
                       .cast("long").alias("priority"))
    none = F.lit(None).cast("long")
    places = jobs.select("weighed", none.alias("rank"), none.alias("turn"), F.col("priority").alias("time"),
                         none.alias("priority"), F.lit(True).alias("is_slot"), F.lit(0).cast("long").alias("node"))
    rows = jobs.withColumns({"is_slot": F.lit(False), "node": F.lit(0).cast("long")}).unionByName(places)
    below = 1
    while below * WAYS < slots:
        below *= WAYS
    while below:
        rows, below = _level(rows, below), below // WAYS
    met = rows.groupBy("weighed", "node").agg(F.max("rank").alias("rank"), F.max("turn").alias("turn"),
                                              F.max(F.when(F.col("is_slot"), F.col("time"))).alias("slot"))
    mine = met.groupBy("rank").agg(F.array_sort(F.collect_list(F.struct("turn", "slot")))["slot"].alias("slots"))
    return quota.join(mine, "rank").select("source", "quota", "parts", "base", "end", "slots")


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__mix_key`` (its source) and ``__mix_n``, its number in the source from 0.

    Numbering goes by (deal, doc_id): documents are dealt to ``DEALS`` groups
    of a source by a hash of doc_id, counted and ordered group by group, so a
    source that holds most rows is still spread over all tasks.
    """
    d = docs.withColumns({"__mix_key": source_key(), "__mix_deal": _deal()})
    sizes = d.groupBy("__mix_key", "__mix_deal").agg(F.count(F.lit(1)).alias("__mix_size"))
    before = sizes.select(
        "__mix_key", "__mix_deal",
        (F.sum("__mix_size").over(W.partitionBy("__mix_key").orderBy("__mix_deal")) - F.col("__mix_size")).alias("__mix_before"))
    group = W.partitionBy("__mix_key", "__mix_deal").orderBy(F.col("doc_id").asc_nulls_first())
    d = d.withColumn("__mix_n", F.row_number().over(group) - 1)
    return (d.join(before, ["__mix_key", "__mix_deal"])
            .withColumn("__mix_n", F.col("__mix_n") + F.col("__mix_before")).drop("__mix_deal", "__mix_before"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK) -> DataFrame:
    """``docs`` with its place in the mixture: all rows, each once.

    Adds ``block`` (number of its block in the source, from 0), ``slot`` (place
    of the block in the schedule), ``release`` and ``deadline`` (slots between
    which it had to come; ``release <= slot < deadline``), ``position`` (rows
    sort by it into the mixture; unique, with gaps where a source's last block
    is short or a source has run out) and ``balanced`` (no source has run out
    before this slot). Columns of ``docs`` with these names are replaced. A
    null source counts as the source ``''``; rows that repeat a doc_id, or have
    none, keep a place each; an empty table gives no rows. Columns whose names
    start with ``__mix_`` are working columns and do not come out.
    """
    counts = docs.groupBy(source_key().alias("source")).agg(F.count(F.lit(1)).alias("n_docs"))
    # one row for each source and the slots of one period in all, whatever the number of documents
    quota = written(quotas(counts, weights, block), "quotas")
    slots = quota.agg(F.max("parts")).first()[0] or 1
    table = period(quota, slots).select(
        "quota", "parts", "base", "end", "slots", F.col("source").alias("__mix_key"))
    table = table.select("__mix_key", *(F.col(c).alias(f"__mix_{c}") for c in ("quota", "parts", "base", "end", "slots")))
    d = numbered(docs).join(F.broadcast(table) if slots <= MOST else table, "__mix_key")
    d = d.withColumn("block", F.floor(F.col("__mix_n") / block))
    turn = (F.col("block") % F.col("__mix_quota")).cast("int")
    parts, quota, base = F.col("__mix_parts"), F.col("__mix_quota"), F.col("__mix_base")
    d = d.withColumns({
        "slot": base + F.floor(F.col("block") / quota) * parts + F.get("__mix_slots", turn),
        "release": base + F.floor(F.col("block") * parts / quota),
        "deadline": base + F.ceil((F.col("block") + 1) * parts / quota)})
    return d.withColumns({
        "position": F.col("slot") * block + F.col("__mix_n") % block,
        "balanced": F.col("slot") < F.col("__mix_end"),
    }).drop("__mix_key", "__mix_n", "__mix_quota", "__mix_parts", "__mix_base", "__mix_end", "__mix_slots")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents").select("doc_id", "source"))


QUERIES = {"op5_mixing": op5_mixing}
ORACLE = {"op5_mixing": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(source, '') AS k,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 3) AS BIGINT) AS deal FROM documents),
num AS (SELECT doc_id, source, k, row_number() OVER (PARTITION BY k ORDER BY deal, doc_id NULLS FIRST) - 1 AS n FROM d),
c AS (SELECT k, count(*) AS n_docs FROM d GROUP BY k),
w AS (SELECT k, n_docs, pow(n_docs, {FLATTEN}) AS w FROM c),
al AS (SELECT CAST(ceil(4 * count(*) / {PARTS}.0) AS BIGINT) * {PARTS} AS parts FROM w),
s AS (SELECT k, n_docs, (parts - count(*) OVER ()) * w / sum(w) OVER () AS share, parts - count(*) OVER () AS spare FROM w, al),
p AS (SELECT k, n_docs, spare, floor(round(share, 6)) AS whole, round(share - floor(round(share, 6)), 6) AS rest FROM s),
q AS (SELECT k, n_docs, CAST(whole + 1 + CASE WHEN row_number() OVER (ORDER BY rest DESC, k) <= spare - sum(whole) OVER ()
                              THEN 1 ELSE 0 END AS BIGINT) AS quota FROM p),
e AS (SELECT min(((n_docs + {BLOCK - 1}) // {BLOCK}) * parts // quota) AS fin FROM q, al),
ql AS (SELECT list(k ORDER BY k) AS ks, list(quota ORDER BY k) AS qs FROM q),
run(slot, served, pick) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(qs, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM ql
  UNION ALL
  SELECT slot + 1, list_transform(served, lambda x, i: x + CASE WHEN i = best THEN 1 ELSE 0 END), best
  FROM (SELECT slot, served, list_position(due, list_min(due)) AS best
        FROM (SELECT slot, served, list_transform(served, lambda x, i: CASE WHEN x * parts // qs[i] <= slot + 1
                 THEN ((x + 1) * parts + qs[i] - 1) // qs[i] ELSE 1000000000000 END) AS due, parts FROM run, ql, al)
        WHERE slot < parts - 1)),
t AS (SELECT ks[pick] AS k, slot AS first_slot, row_number() OVER (PARTITION BY pick ORDER BY slot) - 1 AS turn
      FROM run, ql WHERE slot >= 0),
b AS (SELECT doc_id, source, k, n, n // {BLOCK} AS block FROM num)
SELECT doc_id, source, block, (block // quota) * parts + first_slot AS slot,
       block * parts // quota AS release, ((block + 1) * parts + quota - 1) // quota AS deadline,
       ((block // quota) * parts + first_slot) * {BLOCK} + n % {BLOCK} AS position,
       (block // quota) * parts + first_slot < (SELECT fin FROM e) AS balanced
FROM al, b JOIN q USING (k) JOIN t ON t.k = b.k AND t.turn = b.block % quota
"""}
