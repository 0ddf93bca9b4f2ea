"""Interval algebra over rows (keys..., start_us, end_us). Intervals are half open; touching ones merge.

Unions are gaps and islands; everything with two or more sets is one sweep over end points: each interval
adds one at its start and takes one at its end, a running sum says how many of each set are active, and
neighbouring times make segments. All running values are taken in two levels, within buckets of time and between
them, so that no task orders the rows of a whole key; only one row for each of its buckets meets there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions import times

PAST = (Window.unboundedPreceding, -1)


def positive(rows: DataFrame) -> DataFrame:
    return rows.where("end_us > start_us")


def clipped(rows: DataFrame, low: Column, high: Column) -> DataFrame:
    """The parts of intervals within [low, high)."""
    part = rows.withColumns({"start_us": F.greatest("start_us", low), "end_us": F.least("end_us", high)})
    return positive(part)


#: Stretch of time within which the rows of a key are ordered in one group.
BUCKET = 7 * times.DAY


def bucketed(rows: DataFrame, keys: list[str], at: Column, bucket_us: int = BUCKET) -> DataFrame:
    """Rows dealt by key and ``bucket``, the stretch of time that ``at`` lies in. A key with very many rows is so spread over
    tasks; what follows orders rows within buckets only, and carries one row a bucket on to the next ones."""
    return rows.withColumn("bucket", F.floor(at / bucket_us)).repartition(*keys, "bucket")


def carried(rows: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` of ``bucketed``, with those of ``carry`` (keys, bucket, ...), which have no ``start_us`` and stand first in their buckets."""
    missing = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns if c not in carry.columns]
    return rows.unionByName(carry.select("*", *missing).select(*rows.columns).repartition(*keys, "bucket"))


def top(rows: DataFrame, value: Column) -> Column:
    """The greatest ``value`` of a group of rows of ``bucketed``. All columns are read, so that the shuffle that dealt the rows serves this, too;
    with fewer of them Spark would deal the rows once more."""
    return F.max(F.struct(value.alias("top"), *rows.columns))["top"]


def earlier(keys: list[str]):
    """The buckets of a key before each."""
    return Window.partitionBy(*keys).orderBy("bucket").rowsBetween(*PAST)


def _growing(keys: list[str], *order: str):
    return Window.partitionBy(*keys, "bucket").orderBy(F.col("start_us").asc_nulls_first(), *order)


def behind(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` of ``bucketed`` (by start) with ``past_us``, the latest end of the rows of their key before them; null for a key's first.

    Two levels of a running maximum: within a bucket over its rows, between buckets over their latest ends.
    """
    tops = rows.groupBy(*keys, "bucket").agg(top(rows, F.col("end_us")).alias("end_us"))
    carry = tops.withColumn("end_us", F.max("end_us").over(earlier(keys))).where("end_us is not null")
    past = F.max("end_us").over(_growing(keys, "end_us").rowsBetween(*PAST))
    return carried(rows, carry, keys).withColumn("past_us", past).where("start_us is not null")


def _first_of_run(rows: DataFrame, keys: list[str], begins: Column) -> DataFrame:
    """``first_us``: the start of the last row of the bucket, up to each row, where ``begins`` holds; null where the bucket has none yet."""
    return rows.withColumn("first_us", F.max(F.when(begins, F.col("start_us"))).over(_growing(keys, "end_us").rowsBetween(Window.unboundedPreceding, 0)))


def _across(local: DataFrame, keys: list[str], sums: tuple[str, ...], tops: tuple[str, ...]) -> DataFrame:
    """Whole runs (keys, start_us, end_us, sums, tops) from those of buckets: (keys, bucket, first_us, end_us, ...), first_us null for the rest
    of a run that an earlier bucket began."""
    more = [F.sum(c).alias(c) for c in sums] + [F.max(c).alias(c) for c in tops]
    rest = F.col("first_us").isNull()
    only = [F.max(F.when(rest, F.col(c))).alias(c) for c in ("end_us", *sums, *tops)]
    each = local.groupBy(*keys, "bucket").agg(F.max("first_us").alias("last_us"), *only)
    going = each.withColumn("first_us", F.max("last_us").over(earlier(keys))).where("end_us is not null")
    columns = [*keys, "first_us", "end_us", *sums, *tops]
    parts = local.where("first_us is not null").select(*columns).unionByName(going.select(*columns))
    return parts.groupBy(*keys, F.col("first_us").alias("start_us")).agg(F.max("end_us").alias("end_us"), *more)


def islands(rows: DataFrame, keys: list[str], bucket_us: int = BUCKET) -> DataFrame:
    """Union of intervals per key. No task orders a whole key: see ``behind``."""
    dealt = bucketed(positive(rows.select(*keys, "start_us", "end_us")), keys, F.col("start_us"), bucket_us)
    begins = F.col("past_us").isNull() | (F.col("start_us") > F.col("past_us"))
    local = _first_of_run(behind(dealt, keys), keys, begins).groupBy(*keys, "bucket", "first_us").agg(F.max("end_us").alias("end_us"))
    return _across(local, keys, (), ())


def located(rows: DataFrame, keys: list[str], bucket_us: int = BUCKET) -> DataFrame:
    """Rows of positive length with ``low_us`` and ``high_us``, the bounds of the union interval that each belongs to."""
    dealt = bucketed(positive(rows), keys, F.col("start_us"), bucket_us)
    begins = F.col("past_us").isNull() | (F.col("start_us") > F.col("past_us"))
    local = _first_of_run(behind(dealt, keys), keys, begins)
    # what an earlier bucket began is carried on as its start, then its end is met by it
    lasts = local.groupBy(*keys, "bucket").agg(F.max("first_us").alias("first_us")).withColumn("first_us", F.max("first_us").over(earlier(keys))).where("first_us is not null")
    low = F.coalesce("first_us", F.first("held_us", ignorenulls=True).over(Window.partitionBy(*keys, "bucket")))
    each = carried(local.withColumn("held_us", F.lit(None).cast("long")), lasts.withColumnRenamed("first_us", "held_us"), keys)
    each = each.withColumn("low_us", low).where("start_us is not null").drop("bucket", "past_us", "first_us", "held_us")
    ends = each.groupBy(*keys, "low_us").agg(F.max("end_us").alias("high_us"))
    same = F.lit(True)
    for c in (*keys, "low_us"):
        ends = ends.withColumnRenamed(c, f"of_{c}")
        same &= F.col(c).eqNullSafe(F.col(f"of_{c}"))
    return each.join(ends, same).drop(*[f"of_{c}" for c in (*keys, "low_us")])


def _live(rows: DataFrame, keys: list[str], members: dict[str, Column], bucket_us: int, sizes: DataFrame | None = None) -> DataFrame:
    """(keys, bucket, start_us, end_us, members, columns of sizes): how many of each member are active from one end point to the next.

    In each bucket a row without start stands first, with the counts that the buckets before it leave. Running sums are
    taken within buckets; the buckets' totals carry on, and so do a key's ``sizes``, which only those rows are joined with.
    """
    ends = F.explode(F.array(F.struct(F.col("start_us").alias("t"), F.lit(1).alias("step")), F.struct(F.col("end_us").alias("t"), F.lit(-1).alias("step"))))
    marks = positive(rows).select(*keys, *[m.cast("int").alias(f"in_{n}") for n, m in members.items()], ends.alias("mark"))
    marks = bucketed(marks.select("*", F.col("mark.t").alias("start_us")), keys, F.col("start_us"), bucket_us)
    steps = marks.groupBy(*keys, "bucket", "start_us").agg(*[F.sum(F.col(f"in_{n}") * F.col("mark.step")).alias(n) for n in members])
    whole = steps.groupBy(*keys, "bucket").agg(F.min("start_us").alias("first_us"), *[F.sum(n).alias(n) for n in members])
    before = [F.sum(n).over(earlier(keys)).alias(n) for n in members]
    nexts = F.lead("first_us").over(Window.partitionBy(*keys).orderBy("bucket")).alias("next_us")
    carry = whole.select(*keys, "bucket", *[F.coalesce(c, F.lit(0)).alias(n) for c, n in zip(before, members, strict=True)], nexts)
    told = []
    if sizes is not None:
        told = [c for c in sizes.columns if c not in keys]
        carry = carry.join(sizes, keys, "left")
    every = carried(steps.select("*", F.lit(None).cast("long").alias("next_us"), *[F.lit(None).cast(carry.schema[c].dataType).alias(c) for c in told]), carry, keys)
    order, bucket = _growing(keys), Window.partitionBy(*keys, "bucket")
    sums = {n: F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, 0)) for n in members}
    end = F.coalesce(F.lead("start_us").over(order), F.max("next_us").over(bucket))
    return every.withColumns(sums | {"end_us": end} | {c: F.max(c).over(bucket) for c in told}).drop("next_us")


def beginnings(rows: DataFrame, keys: list[str], members: dict[str, Column], kept: dict[str, Column], bucket_us: int = BUCKET) -> DataFrame:
    """``segments`` with a column for each of ``kept`` (conditions over the counts): whether a run in which it holds begins there."""
    live = _live(rows, keys, members, bucket_us)
    order = _growing(keys)
    live = live.withColumns({f"now_{n}": F.coalesce(c, F.lit(False)) for n, c in kept.items()})
    live = live.withColumns({n: F.col(f"now_{n}") & ~F.coalesce(F.lag(f"now_{n}").over(order), F.lit(False)) for n in kept})
    return live.where("start_us is not null and end_us is not null").select(*keys, "start_us", *members, "end_us", *kept)


def segments(rows: DataFrame, keys: list[str], members: dict[str, Column], bucket_us: int = BUCKET) -> DataFrame:
    """Stretches (keys, start_us, end_us) between end points, with how many intervals of each member are active."""
    live = _live(rows, keys, members, bucket_us).where("start_us is not null and end_us is not null")
    return live.select(*keys, "start_us", *members, "end_us")


def runs(rows: DataFrame, keys: list[str], members: dict[str, Column], keep: Column, sums: dict[str, Column] | None = None, bucket_us: int = BUCKET, sizes: DataFrame | None = None) -> DataFrame:
    """Union of the stretches where ``keep`` holds over the members' counts, from one sweep.

    ``sums`` are conditions over the counts: each adds a column of the time within a run for which it holds.
    ``sizes`` (keys, more columns) may add columns of its own to the counts; keys that it lacks have null there.
    """
    live = _live(rows, keys, members, bucket_us, sizes)
    keep = F.coalesce(keep, F.lit(False))
    order = _growing(keys)
    live = live.withColumn("kept", keep).withColumn("going", F.lag("kept").over(order))
    live = live.withColumn("first_us", F.max(F.when(F.col("kept") & ~F.coalesce("going", F.lit(False)), F.col("start_us"))).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    length = F.col("end_us") - F.col("start_us")
    held = {n: F.when(F.coalesce(c, F.lit(False)), length).otherwise(0) for n, c in (sums or {}).items()}
    local = live.where("kept and start_us is not null and end_us is not null").withColumns(held).groupBy(*keys, "bucket", "first_us").agg(F.max("end_us").alias("end_us"), *[F.sum(n).alias(n) for n in held])
    return _across(local, keys, tuple(held), ())


def both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two sets in one table, told apart by ``side``."""
    return a.withColumn("side", F.lit("a")).unionByName(b.withColumn("side", F.lit("b")))


def _two(a: DataFrame, b: DataFrame, keys: list[str], keep: str) -> DataFrame:
    rows = both(a.select(*keys, "start_us", "end_us"), b.select(*keys, "start_us", "end_us"))
    return runs(rows, keys, {"a": F.col("side") == "a", "b": F.col("side") == "b"}, F.expr(keep))


def intersection(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return _two(a, b, keys, "a > 0 and b > 0")


def difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return _two(a, b, keys, "a > 0 and b = 0")


def union(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return _two(a, b, keys, "a > 0 or b > 0")


def all_active(rows: DataFrame, keys: list[str], member: str, sizes: DataFrame) -> DataFrame:
    """Stretches in which every member of a group is active. ``sizes`` (keys, members) comes from the dimension,
    so a member without any interval leaves the group's intersection empty."""
    alone = islands(rows, [*keys, member])
    return runs(alone, keys, {"active": F.lit(True)}, F.col("active") == F.col("members"), sizes=sizes)


def total_us(rows: DataFrame, keys: list[str], name: str = "us") -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(F.col("end_us") - F.col("start_us")).alias(name))


def by_local_day(rows: DataFrame, zone: str = times.ZONE) -> DataFrame:
    """Intervals cut at local midnights, with ``day``."""
    last = times.local_day(F.col("end_us") - 1, zone)
    days = rows.withColumn("day", F.explode(F.sequence(times.local_day(F.col("start_us"), zone), last)))
    return clipped(days, times.midnight(F.col("day"), zone), times.midnight(F.date_add("day", 1), zone))


def overlapping(rows: DataFrame, others: DataFrame, keys: list[str], how: str = "left_semi", bucket_us: int = BUCKET) -> DataFrame:
    """Rows that overlap (``left_semi``) or do not overlap (``left_anti``) any interval of ``others`` of the same keys.

    A row overlaps one exactly if the latest end of those that start before the row's end is after its start. So each
    row and each other interval is one row of a running maximum in two levels, however long they are; nothing is joined.
    """
    none = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns if c not in {*keys, "start_us", "end_us"}]
    asked = rows.select("*", F.lit(False).alias("other"), F.col("end_us").alias("at"))
    known = positive(others).select(*keys, "start_us", "end_us", *none, F.lit(True).alias("other"), F.col("start_us").alias("at"))
    every = bucketed(asked.unionByName(known), keys, F.col("at"), bucket_us)
    carry = every.groupBy(*keys, "bucket").agg(top(every, F.when(F.col("other"), F.col("end_us"))).alias("end_us"))
    carry = carry.withColumn("end_us", F.max("end_us").over(earlier(keys))).where("end_us is not null").withColumn("other", F.lit(True))
    order = Window.partitionBy(*keys, "bucket").orderBy(F.col("at").asc_nulls_first(), "other").rowsBetween(*PAST)
    last = F.max(F.when(F.col("other"), F.col("end_us"))).over(order)
    hit = F.coalesce(F.col("last_us") > F.col("start_us"), F.lit(False))
    out = carried(every, carry, keys).withColumn("last_us", last).where("not other")
    return out.where(hit if how == "left_semi" else ~hit).select(*rows.columns)


def covered_until(rows: DataFrame, asked: DataFrame, keys: list[str], bucket_us: int = BUCKET) -> DataFrame:
    """``asked`` (keys, at_us, more columns) with ``covered_us``, the union time of its key's intervals before ``at_us``.

    The intervals that start before an instant cover the lengths that each adds to those before it, less what the latest
    of their ends is beyond the instant. Both are running values in two levels, so any number of instants is
    answered by one sweep over the intervals and the instants.
    """
    none = [F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in asked.columns if c not in keys]
    known = positive(rows).select(*keys, *none, "start_us", "end_us", F.lit(False).alias("asks"), F.col("start_us").alias("at"))
    probes = asked.select("*", F.col("at_us").alias("start_us"), F.lit(None).cast("long").alias("end_us"), F.lit(True).alias("asks"), F.col("at_us").alias("at"))
    every = bucketed(known.select(*probes.columns).unionByName(probes), keys, F.col("at"), bucket_us)
    order = Window.partitionBy(*keys, "bucket").orderBy(F.col("at").asc_nulls_first(), F.desc("asks"), "end_us")
    tops = every.groupBy(*keys, "bucket").agg(top(every, F.col("end_us")).alias("end_us")).withColumn("end_us", F.max("end_us").over(earlier(keys)))
    every = carried(every, tops.where("end_us is not null"), keys).withColumn("past_us", F.max("end_us").over(order.rowsBetween(*PAST)))
    fresh = F.greatest(F.col("end_us") - F.greatest("at", "past_us"), F.lit(0))
    every = every.where("at is not null").withColumn("fresh_us", F.when(F.col("asks"), 0).otherwise(fresh))
    sums = every.groupBy(*keys, "bucket").agg(F.sum("fresh_us").alias("fresh_us")).withColumn("fresh_us", F.sum("fresh_us").over(earlier(keys)))
    every = carried(every, sums.where("fresh_us is not null"), keys)
    every = every.withColumn("sum_us", F.sum("fresh_us").over(order.rowsBetween(Window.unboundedPreceding, 0))).where("asks")
    beyond = F.greatest(F.coalesce(F.col("past_us") - F.col("at_us"), F.lit(0)), F.lit(0))
    return every.select(*asked.columns, (F.col("sum_us") - beyond).alias("covered_us"))
