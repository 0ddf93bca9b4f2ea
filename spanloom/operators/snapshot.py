"""The state as of an instant: open intervals, period totals, follow-ups that are due, episodes and their ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions import times, words
from spanloom.operators import intervals

HOUR = 3600 * times.SECOND
FOLLOW_UPS = (0, 24, 72, 168)


def cut_at(rows: DataFrame, now_us: Column) -> DataFrame:
    """Intervals known at ``now_us``: closed ones, and open ones without an end; later ones are unknown."""
    known = rows.where(F.col("start_us") <= now_us)
    return known.withColumn("end_us", F.when(F.col("end_us") <= now_us, F.col("end_us")))


def open_intervals(rows: DataFrame, keys: list[str], now_us: Column, oldest_us: int = 36 * HOUR) -> DataFrame:
    """The open interval of each key: the latest one, not older than ``oldest_us``; with how many are open."""
    open_rows = rows.where(F.col("end_us").isNull())
    last = rows.groupBy(*keys).agg(F.max("start_us").alias("last_us"))
    one = open_rows.groupBy(*keys).agg(F.count("*").alias("open_n"), F.max("start_us").alias("start_us")).join(last, keys)
    return one.withColumns({"age_us": now_us - F.col("start_us"), "valid": (F.col("open_n") == 1) & (F.col("start_us") == F.col("last_us")) & (now_us - F.col("start_us") <= oldest_us)})


def periods(spark, now_us: int, zone: str = times.ZONE) -> DataFrame:
    """(period, low_us): local day, week, month and quarter so far, the last 7 to 180 days, all time."""
    day = times.local_day(F.lit(now_us), zone)
    starts = {"day": day, "week": times.week(day), "month": times.month(day), "quarter": F.to_date(F.date_trunc("quarter", day)),
              **{f"last{n}": F.date_sub(day, n - 1) for n in (7, 28, 30, 90, 180)}}
    rows = [F.struct(F.lit(n).alias("period"), times.midnight(d, zone).alias("low_us")) for n, d in starts.items()]
    rows.append(F.struct(F.lit("all").alias("period"), F.lit(-(2**62)).alias("low_us")))
    return spark.range(1).select(F.explode(F.array(*rows)).alias("p")).select("p.*").withColumn("high_us", F.lit(now_us))


def period_totals(rows: DataFrame, keys: list[str], when: DataFrame) -> DataFrame:
    """Union time of each key in each period of ``when`` (period, low_us, high_us): covered time up to its end less that up to its begin.

    One sweep answers all periods, be they ten or a thousand; a key has as many rows more as there are bounds.
    """
    bounds = F.explode(F.array(F.struct(F.lit(-1).alias("sign"), F.col("low_us").alias("at_us")), F.struct(F.lit(1).alias("sign"), F.col("high_us").alias("at_us"))))
    asked = rows.select(*keys).distinct().crossJoin(when.select("period", bounds.alias("b")).select("period", "b.*"))
    found = intervals.covered_until(rows, asked, keys)
    return found.groupBy(*keys, "period").agg(F.sum(F.col("sign") * F.col("covered_us")).alias("closed_us")).where("closed_us > 0")


def provisional_totals(closed: DataFrame, opened: DataFrame, keys: list[str], when: DataFrame, now_us: Column) -> DataFrame:
    """Period totals of closed intervals, and of them with the open ones up to now: (keys, period, closed_us, provisional_us)."""
    columns = [*keys, "start_us", "end_us"]
    every = closed.select(*columns).unionByName(opened.select(*keys, "start_us", now_us.cast("long").alias("end_us")))
    both = period_totals(every, keys, when).withColumnRenamed("closed_us", "provisional_us")
    return both.join(period_totals(closed, keys, when), [*keys, "period"], "left").na.fill(0, ["closed_us"]).select(*keys, "period", "closed_us", "provisional_us")


SKEW, CAPTURE_AGE = 120 * times.SECOND, 8 * HOUR


def usable_open(rows: DataFrame, now_us: Column, zone: str = times.ZONE) -> DataFrame:
    """Open intervals (start_us, captured_us) with ``reasons`` why they may not be shown as going on.

    A capture may be ``SKEW`` ahead of the clock and ``CAPTURE_AGE`` old, and must be of the same local day as now.
    """
    age = now_us - F.col("captured_us")
    reasons = F.array_compact(F.array(
        F.when(F.col("captured_us").isNull(), "no capture"), F.when(age < -SKEW, "captured in the future"), F.when(age > CAPTURE_AGE, "capture too old"),
        F.when(times.local_day(F.col("captured_us"), zone) != times.local_day(now_us, zone), "captured on another day"),
        F.when(F.col("start_us") > F.col("captured_us") + SKEW, "starts after its capture")))
    return rows.withColumns({"reasons": reasons, "usable": F.size(reasons) == 0})


def overlapping_open(open_rows: DataFrame, closed: DataFrame, keys: list[str]) -> DataFrame:
    """Open intervals whose start lies inside a closed one: violations."""
    late = closed.groupBy(*keys).agg(F.max("end_us").alias("last_end_us"))
    return open_rows.join(late, keys).where("start_us < last_end_us")


def due(rows: DataFrame, now_us: Column, done: DataFrame | None = None, hours: tuple[int, ...] = FOLLOW_UPS) -> DataFrame:
    """(event_id, hours) of follow-ups whose time has come and which are not done."""
    every = rows.select("event_id", "end_us", F.explode(F.array(*map(F.lit, hours))).alias("hours"))
    ready = every.where(F.col("end_us") + F.col("hours") * HOUR <= now_us)
    return ready if done is None else ready.join(done.select("event_id", "hours"), ["event_id", "hours"], "left_anti")


def eligible(rows: DataFrame, cutoff_us: Column) -> DataFrame:
    return rows.where(F.col("end_us") >= cutoff_us)


def episodes(rows: DataFrame, key: str) -> DataFrame:
    """Union intervals with their ids."""
    united = intervals.islands(rows, [key])
    return united.withColumn("episode_id", words.episode_id(F.col(key).cast("string"), times.iso(F.col("start_us")), times.iso(F.col("end_us"))))


def superseded(rows: DataFrame, key: str) -> DataFrame:
    """Raw rows with the id of the episode that stands for them, null where they are that episode themselves."""
    placed = intervals.located(rows, [key])
    name = words.episode_id(F.col(key).cast("string"), times.iso(F.col("low_us")), times.iso(F.col("high_us")))
    alone = (F.col("start_us") == F.col("low_us")) & (F.col("end_us") == F.col("high_us"))
    return placed.withColumn("superseded_by", F.when(~alone, name)).drop("low_us", "high_us")


def progress(rows: DataFrame, most_failed: float = 0.5) -> DataFrame:
    """Totals by state in one row, and whether failures are systemic."""
    out = rows.agg(F.count("*").alias("total"), F.count_if(F.col("state") == "done").alias("done"), F.count_if(F.col("state") == "failed").alias("failed"))
    return out.withColumn("systemic", F.col("failed") > F.col("total") * most_failed)
