"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

Golden-ratio points are mapped through the sources' cumulative target shares: slot ``t`` of the mix belongs
to the source whose share holds ``frac(t * phi)``, so every stretch of slots holds each source nearly in
proportion. A source's documents are put into a shuffled order by hash, end to end and twice over, and cut
into blocks of ``BLOCK`` words; the source's slot of rank ``r`` is joined to its block ``r``, and a document
takes the words that its joined blocks hold. Ranks and places are prefix sums in two levels (a stretch of
slots or a part of the hash range, then within it), so no source is ordered in one task however large it is.

Defined results: a null text has size 0; a null source is a source of its own that sorts last; a source
without words has target 0 and takes nothing; repeated rows are documents of their own; equal hashes go by
doc_id and size; extra columns are ignored unless asked for; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.shared import settled

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BLOCK = 32
#: Parts of a source's shuffled order, as bits of the hash; grid cells of the cumulative shares.
PART_BITS = 14
CELLS = 4096
_LOW = 1 << 20
#: frac(phi) and frac(2^20 * phi): with both, slots up to 2^40 keep 32 exact bits.
_PHI = (5**0.5 - 1) / 2
_PHI_HIGH = ((_LOW * 0x9E3779B97F4A7C15F39CC0605CEDC835) % (1 << 128)) / (1 << 128)


def named(source: Column) -> Column:
    """A source as a string that is never null, so that joins need no null-safe comparison."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def sized(docs: DataFrame, keep: list[str], seed: int = 0) -> DataFrame:
    """``keep`` as __k0, __k1 ... and source, size in words, and the place in the shuffled order as part and hash."""
    mark = F.xxhash64("doc_id", F.lit(seed))
    rows = docs.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)], F.col("doc_id").alias("__doc_id"), F.col("source").alias("__source"),
                       named(F.col("source")).alias("__name"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("__size"), mark.alias("__h"))
    return rows.withColumn("__part", F.shiftrightunsigned("__h", 64 - PART_BITS))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, weight, target) from rows (source, source_size), one row per source.

    The total is shared by weight; what a source may not take beyond ``most`` times its size is shared by
    the others, until none is above. Sorted by how early they fill up, all sources before the first that
    does not fill up are full, and the others share the rest at one level.
    """
    name, fill = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("full_at", F.col("source").asc_nulls_last())
    rows = sizes.withColumn("turn", F.row_number().over(name) - 1)
    rows = rows.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod("turn", F.lit(len(weights))) + 1).cast("int")))
    rows = rows.withColumn("cap", most * F.col("source_size")).withColumn("full_at", F.col("cap") / F.col("weight"))
    rows = rows.withColumn("given", F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
    rows = rows.withColumn("open", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
    rows = rows.withColumn("total", share * F.sum("source_size").over(Window.partitionBy()))
    rows = rows.withColumn("level", (F.col("total") - F.col("given")) / F.col("open"))
    first = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(Window.partitionBy())
    rows = rows.withColumn("level", first["level"])
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight")))
    return rows.select("source", "source_size", "weight", target.cast("double").alias("target"))


def point(slot: Column) -> Column:
    """The slot's golden-ratio point in [0, 1)."""
    low, high = F.pmod(slot, F.lit(_LOW)), F.floor(slot / _LOW)
    x = (low + 0.5) * F.lit(_PHI) + high * F.lit(_PHI_HIGH)
    return x - F.floor(x)


def schedule(goals: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, source) of the whole mix, from ``targets``; one row per block of ``block`` words."""
    spark = goals.sparkSession
    order = Window.orderBy(F.col("source").asc_nulls_last())
    share = goals.withColumn("high", F.sum("target").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    total = share.agg(F.max("high")).first()[0] or 0.0
    if not total:
        return spark.range(0).select(F.col("id").alias("slot"), F.lit(None).cast("string").alias("source"))
    share = share.where("target > 0").select("source", ((F.col("high") - F.col("target")) / total).alias("low"), (F.col("high") / total).alias("high"))
    cell = F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1))))
    share = share.withColumn("cell", cell)
    slots = spark.range(-int(-total // block)).select(F.col("id").alias("slot"), point(F.col("id")).alias("x"))
    slots = slots.withColumn("cell", F.floor(F.col("x") * CELLS))
    return slots.join(share, "cell").where("x >= low and x < high").select("slot", "source")


def ranked(slots: DataFrame, count: int) -> DataFrame:
    """A schedule of ``count`` slots, with each slot's rank among those of its source, which is the block it takes."""
    slots = slots.withColumn("source", named(F.col("source"))).withColumn("chunk", F.floor(F.col("slot") / max(1, math.isqrt(count))))
    before = slots.groupBy("source", "chunk").agg(F.count("*").alias("n"))
    before = before.selectExpr("source", "chunk", "sum(n) OVER (PARTITION BY source ORDER BY chunk) - n AS before")
    own = slots.selectExpr("*", "row_number() OVER (PARTITION BY source, chunk ORDER BY slot) - 1 AS own")
    return own.join(before, ["source", "chunk"]).select("slot", F.col("source").alias("__name"), (F.col("own") + F.col("before")).alias("block"))


def block_parts(rows: DataFrame, block: int) -> DataFrame:
    """(__name, block, place, words): how many words of each document each block of its source holds, in both turns."""
    turns = F.array(F.col("place"), F.col("place") + F.col("source_size"))
    rows = rows.where("__size > 0").select("__name", "place", "__size", F.explode(turns).alias("start"))
    rows = rows.withColumn("end", F.col("start") + F.col("__size"))
    rows = rows.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))))
    words = F.least("end", (F.col("block") + 1) * block) - F.greatest("start", F.col("block") * block)
    return rows.select("__name", "block", "place", words.alias("words"))


def _placed(docs: DataFrame, keep: list[str], seed: int, block: int) -> DataFrame:
    rows = sized(docs, keep, seed)
    if "text" not in keep:
        rows = settled(rows)
    parts = settled(rows.groupBy("__source", "__name", "__part").agg(F.sum("__size").alias("n")))
    goals = settled(targets(parts.groupBy(F.col("__source").alias("source")).agg(F.sum("n").alias("source_size"))))
    parts = parts.selectExpr("__name", "__part", "sum(n) OVER (PARTITION BY __name ORDER BY __part) - n AS before")
    parts = settled(parts.join(goals.select(named(F.col("source")).alias("__name"), "source_size", "target"), "__name"))
    within = Window.partitionBy("__name", "__part").orderBy("__h", "__doc_id", "__size").rowsBetween(Window.unboundedPreceding, 0)
    light = rows.select("__name", "__part", "__h", "__doc_id", "__size") if "text" in keep else rows
    placed = lambda x: x.withColumn("within", F.sum("__size").over(within) - F.col("__size")).join(parts, ["__name", "__part"]).withColumn("place", F.col("before") + F.col("within"))
    slots = schedule(goals, block)
    count = int(-(-(goals.agg(F.sum("target")).first()[0] or 0.0) // block))
    joined = block_parts(placed(light), block).join(ranked(slots, count), ["__name", "block"])
    taken = joined.groupBy("__name", "place").agg(F.sum("words").alias("taken"), F.min("slot").alias("slot"))
    # a document without words shares its place with the one after it
    taken = taken.withColumn("__some", F.lit(True))
    return placed(rows).withColumn("__some", F.col("__size") > 0).join(taken, ["__name", "place", "__some"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)))


def mixed(docs: DataFrame, keep: list[str], seed: int = 0, block: int = BLOCK) -> DataFrame:
    """``keep`` and size, source_size, target, taken, ``place``, the document's first word in its source's order, and
    ``slot``, the first slot of the mix that takes of it (null where none does).

    A document takes those of its words, in its first and second turn, that lie in scheduled blocks.
    """
    rows = _placed(docs, keep, seed, block)
    own = [F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)]
    return rows.select(*own, F.col("__size").alias("size"), "source_size", "target", "taken", "place", "slot")


def repeated(docs: DataFrame, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """The documents as often as the mix takes them, parts rounded: not at all, once or twice."""
    rows = _placed(docs, docs.columns, seed, block).where("__size > 0")
    times = F.round(F.col("taken") / F.col("__size")).cast("int")
    rows = rows.withColumn("turn", F.explode(F.filter(F.array(F.lit(1), F.lit(2)), lambda i: i <= times)))
    return rows.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(docs.columns)])
