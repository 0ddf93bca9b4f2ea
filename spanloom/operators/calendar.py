"""Calendar aggregates of interval tables: days, months, weeks, rolling weeks, headline figures, comparisons.

Counts and mean lengths belong to the local day on which an interval starts; time under alert is cut at
local midnights and counts overlaps once. Means are of events: sums and counts are kept, and divided last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions import times
from spanloom.operators import intervals


def covered_daily(rows: DataFrame, keys: list[str], zone: str = times.ZONE) -> DataFrame:
    """(keys, day, alert_us): time under alert, overlaps once."""
    parts = intervals.by_local_day(intervals.islands(rows, keys), zone)
    return intervals.total_us(parts, [*keys, "day"], "alert_us")


def started_daily(rows: DataFrame, keys: list[str], zone: str = times.ZONE) -> DataFrame:
    """(keys, day, alerts_started, length_us) by the local day of the start."""
    length = F.greatest(F.col("end_us") - F.col("start_us"), F.lit(0))
    return rows.groupBy(*keys, times.local_day(F.col("start_us"), zone).alias("day")).agg(F.count("*").alias("alerts_started"), F.sum(length).alias("length_us"))


def daily(rows: DataFrame, keys: list[str], zone: str = times.ZONE) -> DataFrame:
    """Dense days of each key, from its first start to its last end, with counts, lengths and time under alert.

    Behind the ends of those before it, each row adds a piece of time that no other adds, so its pieces by day sum up to
    time under alert. Days without rows are filled in up to a key's next day.
    """
    dealt = intervals.bucketed(rows.select(*keys, "start_us", "end_us"), keys, F.col("start_us"))
    rows = intervals.behind(dealt, keys).withColumn("fresh_us", F.greatest("start_us", "past_us"))
    length, zero = F.greatest(F.col("end_us") - F.col("start_us"), F.lit(0)), F.lit(0).cast("long")
    part = lambda day, n, us, alert: F.struct(day.alias("day"), n.alias("n"), us.alias("us"), alert.alias("alert"))
    days = F.sequence(times.local_day(F.col("fresh_us"), zone), times.local_day(F.col("end_us") - 1, zone))
    inside = lambda d: F.least("end_us", times.midnight(F.date_add(d, 1), zone)) - F.greatest("fresh_us", times.midnight(d, zone))
    started = F.array(part(times.local_day(F.col("start_us"), zone), F.lit(1).cast("long"), length, zero))
    covered = F.transform(days, lambda d: part(d, zero, zero, inside(d)))
    parts = rows.select(*keys, F.explode(F.when(F.col("end_us") > F.col("fresh_us"), F.concat(started, covered)).otherwise(started)).alias("p")).select(*keys, "p.*")
    held = parts.groupBy(*keys, "day").agg(F.sum("n").alias("alerts_started"), F.sum("us").alias("length_us"), F.sum("alert").alias("alert_us"))
    until = F.coalesce(F.date_sub(F.lead("day").over(Window.partitionBy(*keys).orderBy("day")), 1), F.col("day"))
    dense = held.withColumn("until", until).withColumn("each", F.explode(F.sequence("day", "until")))
    own = lambda c: F.when(F.col("each") == F.col("day"), F.col(c)).otherwise(0).alias(c)
    return dense.select(*keys, F.col("each").alias("day"), own("alerts_started"), own("length_us"), own("alert_us"))


def _summed(days: DataFrame, keys: list[str]) -> DataFrame:
    return days.groupBy(*keys).agg(
        F.sum("alerts_started").alias("alerts_started"), F.sum("length_us").alias("length_us"),
        F.sum("alert_us").alias("alert_us"), F.count("*").alias("days"),
    )


def _rates(rows: DataFrame, days: Column) -> DataFrame:
    hour, minute = 3600 * times.SECOND, 60 * times.SECOND
    return rows.withColumns({
        "alerts_per_day": times.round3(times.ratio(F.col("alerts_started"), days)),
        "alert_hours_per_day": times.round3(times.ratio(F.col("alert_us"), days * hour)),
        "mean_minutes": times.round3(times.ratio(F.col("length_us"), F.col("alerts_started") * minute)),
    })


def _complete(days: DataFrame, keys: list[str], period: Column, length: Column, skip_first: bool) -> DataFrame:
    return _whole(_summed(days.withColumn("period", period), [*keys, "period"]), keys, length, skip_first)


def _whole(rows: DataFrame, keys: list[str], length: Column, skip_first: bool) -> DataFrame:
    if skip_first:
        first = F.min("period").over(Window.partitionBy(*keys))
        rows = rows.withColumn("first", first).where("period > first").drop("first")
    return _rates(rows.where(F.col("days") == length), length)


def monthly(days: DataFrame, keys: list[str], skip_first: bool = False) -> DataFrame:
    """Complete calendar months of a dense daily table; ``skip_first`` leaves out the month of a key's first day."""
    return _complete(days, keys, times.month(F.col("day")), times.days_in_month(F.col("period")), skip_first)


def weekly(days: DataFrame, keys: list[str], skip_first: bool = False) -> DataFrame:
    """Complete weeks, Monday to Sunday; ``skip_first`` leaves out the week of a key's first day."""
    return _complete(days, keys, times.week(F.col("day")), F.lit(7), skip_first)


def covered_months(rows: DataFrame, keys: list[str], zone: str = times.ZONE) -> DataFrame:
    """(keys, period, alerts_started, length_us, alert_us, days) of each key's months, from its first start to its last end: the sums of
    ``daily`` by month, with how many of its days a month has, without a row for each day.

    Pieces of time are cut at months instead of days, so one interval makes one or a few.
    """
    dealt = intervals.bucketed(rows.select(*keys, "start_us", "end_us"), keys, F.col("start_us"))
    fresh = F.greatest("start_us", "past_us")
    day = lambda c: times.local_day(F.col(c), zone)
    rows = intervals.behind(dealt, keys).select(*keys, "start_us", "end_us", fresh.alias("fresh_us"))
    adds = F.col("end_us") > F.col("fresh_us")
    rows = rows.select(*keys, "end_us", "fresh_us", F.greatest(F.col("end_us") - F.col("start_us"), F.lit(0)).alias("length"),
                       F.explode(F.array(F.struct(day("start_us").alias("begun"), F.when(adds, day("fresh_us")).alias("low"), F.when(adds, times.local_day(F.col("end_us") - 1, zone)).alias("high")))).alias("d"))
    zero = F.lit(0).cast("long")
    part = lambda month, n, us, alert, low, high: F.struct(month.alias("period"), n.alias("n"), us.alias("us"), alert.alias("alert"), low.alias("low"), high.alias("high"))
    begun, low, high = F.col("d.begun"), F.col("d.low"), F.col("d.high")
    started = F.array(part(times.month(begun), F.lit(1).cast("long"), F.col("length"), zero, begun, begun))
    months = F.sequence(times.month(low), times.month(high), F.expr("INTERVAL 1 MONTH"))
    inside = lambda m: F.least("end_us", times.midnight(F.add_months(m, 1), zone)) - F.greatest("fresh_us", times.midnight(m, zone))
    covered = F.coalesce(F.transform(months, lambda m: part(m, zero, zero, inside(m), low, high)), F.array())
    parts = rows.select(*keys, F.inline(F.concat(started, covered)))
    held = parts.groupBy(*keys, "period").agg(F.sum("n").alias("alerts_started"), F.sum("us").alias("length_us"), F.sum("alert").alias("alert_us"), F.min("low").alias("low"), F.max("high").alias("high"))
    key = Window.partitionBy(*keys)
    until = F.coalesce(F.add_months(F.lead("period").over(key.orderBy("period")), -1), F.col("period"))
    dense = held.withColumns({"first": F.min("low").over(key), "last": F.max("high").over(key), "until": until})
    dense = dense.withColumn("each", F.explode(F.sequence("period", "until", F.expr("INTERVAL 1 MONTH"))))
    own = lambda c: F.when(F.col("each") == F.col("period"), F.col(c)).otherwise(0).alias(c)
    days = F.datediff(F.least("last", F.last_day("each")), F.greatest("first", "each")) + 1
    return dense.select(*keys, F.col("each").alias("period"), own("alerts_started"), own("length_us"), own("alert_us"), days.cast("long").alias("days"))


def complete_months(rows: DataFrame, keys: list[str], skip_first: bool = False, zone: str = times.ZONE) -> DataFrame:
    """``monthly`` of the ``daily`` table of these intervals, made from ``covered_months``."""
    return _whole(covered_months(rows, keys, zone), keys, times.days_in_month(F.col("period")), skip_first)


def after_first_day(periods: DataFrame, days: DataFrame, keys: list[str]) -> DataFrame:
    """Periods that begin after their key's first day; one that begins on it goes too."""
    first = days.groupBy(*keys).agg(F.min("day").alias("first_day"))
    return periods.join(first, keys).where("period > first_day").drop("first_day")


def last_days(days: DataFrame, keys: list[str], n: int = 28) -> DataFrame:
    """The last ``n`` days of each key's dense table, with minutes rounded as they are published."""
    rows = days.withColumn("end_day", F.max("day").over(Window.partitionBy(*keys))).where(F.col("day") > F.date_sub("end_day", n)).drop("end_day")
    return rows.withColumn("alert_minutes", times.round3(F.col("alert_us") / (60 * times.SECOND)))


def headline(days: DataFrame, keys: list[str], rounded_twice: bool = False) -> DataFrame:
    """Totals, mean length, and the days of most alerts and of most time; the first day wins a tie."""
    hours = F.sum("alert_minutes") / 60 if rounded_twice else F.sum("alert_us") / (3600 * times.SECOND)
    first = lambda c: F.max_by("day", F.struct(F.col(c), -F.unix_date("day")))
    rows = days.groupBy(*keys).agg(
        F.sum("alerts_started").alias("alerts"), F.sum("length_us").alias("length_us"), times.round3(hours).alias("alert_hours"),
        first("alerts_started").alias("busiest_day"), first("alert_us").alias("longest_day"),
    )
    return rows.withColumn("mean_minutes", times.round3(times.ratio(F.col("length_us"), F.col("alerts") * 60 * times.SECOND))).drop("length_us")


def rolling(days: DataFrame, keys: list[str], n: int = 7) -> DataFrame:
    """Sliding windows of ``n`` complete days, one for each end day; each key's first day is left out."""
    first = Window.partitionBy(*keys).orderBy("day")
    rows = days.withColumn("turn", F.row_number().over(first)).where("turn > 1").drop("turn")
    window = first.rowsBetween(1 - n, 0)
    sums = {c: F.sum(c).over(window) for c in ("alerts_started", "length_us", "alert_us")}
    return _rates(rows.withColumns(sums | {"held": F.count("*").over(window)}).where(F.col("held") == n).drop("held"), F.lit(n))


def compared(rows: DataFrame, time: str, who: str, names: list, value: str) -> DataFrame:
    """One column per name, over the times that all of them have."""
    whole = rows.where(F.col(who).isin(names)).groupBy(time).agg(F.count_distinct(who).alias("held")).where(F.col("held") == len(names))
    wide = rows.join(whole, time, "left_semi").groupBy(time).pivot(who, names).agg(F.first(value))
    return wide.select(time, *[F.col(str(n)).alias(f"{value}_{n}") for n in names])


def appended(base: DataFrame, live: DataFrame) -> DataFrame:
    """The base, and those live rows that start after the base's last start of their key's table."""
    last = base.agg(F.max("start_us").alias("last_us"))
    late = live.join(F.broadcast(last), F.expr("last_us is null or start_us > last_us"))
    return base.withColumn("appended", F.lit(False)).unionByName(late.drop("last_us").withColumn("appended", F.lit(True)))


def in_order(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows by the columns, empty values first, as published files have them."""
    return rows.orderBy(*[F.col(c).asc_nulls_first() for c in columns])
