"""Incremental ingest of polled histories: upsert, continuity, gates, pairing of marks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions import times, words
from spanloom.operators import intervals

STALE = 36 * 3600 * times.SECOND


def upserted(store: DataFrame, polled: DataFrame, key: list[str]) -> DataFrame:
    """Store and poll by key: the latest fetch's values, with the first and last fetch times kept.

    Both have ``fetched_us``; the store may have ``first_fetched_us``. The same function serves a stream's batches.
    """
    if "first_fetched_us" not in store.columns:
        store = store.withColumn("first_fetched_us", F.col("fetched_us"))
    rows = store.unionByName(polled.withColumn("first_fetched_us", F.col("fetched_us")))
    rest = [c for c in rows.columns if c not in {*key, "first_fetched_us"}]
    newest = rows.groupBy(*key).agg(F.max(F.struct("fetched_us", *[c for c in rest if c != "fetched_us"])).alias("row"), F.min("first_fetched_us").alias("first_fetched_us"))
    return newest.select(*key, *[F.col(f"row.{c}").alias(c) for c in rest], "first_fetched_us")


#: Why a region's history is continuous or not.
REASONS = {"missing": "region_missing_from_history_payload", "reached": "history_overlaps_upstream", "short": "history_window_does_not_reach_upstream"}


def continuity(targets: DataFrame, polled: DataFrame, groups: DataFrame | None = None, limit: int = 25) -> DataFrame:
    """Whether each target's poll reaches back to its cutoff (``cutoff_us``), with the reason.

    ``groups`` (region) are the regions that the poll answered for, also those with an empty history; without
    it, those with rows. All rows count for the oldest start and the limit; only completed air alerts
    (``kind`` AIR, or any where there is no such column) give the latest end.
    """
    air = F.upper("kind") == "AIR" if "kind" in polled.columns else F.lit(True)
    done = air & (F.col("end_us") > F.col("start_us"))
    seen = polled.groupBy("region").agg(F.min("start_us").alias("oldest_us"), F.max(F.when(done, F.col("end_us"))).alias("latest_us"),
                                        F.count("*").alias("history_n"), F.count_if(done).alias("completed_n"))
    groups = polled if groups is None else groups
    rows = targets.join(groups.select("region").distinct().withColumn("present", F.lit(True)), "region", "left").join(seen, "region", "left").na.fill(0, ["history_n", "completed_n"])
    reached = F.coalesce(F.col("oldest_us") <= F.col("cutoff_us"), F.lit(False))
    reason = F.when(F.col("present").isNull(), REASONS["missing"]).when(reached, REASONS["reached"]).otherwise(REASONS["short"])
    return rows.withColumns({"limit_hit": F.col("history_n") >= limit, "continuous": reached & F.col("present").isNotNull(), "reason": reason}).drop("present")


def bridged(polled: DataFrame, status: DataFrame) -> DataFrame:
    """Events of continuous regions that end after the region's cutoff."""
    return polled.join(status.where("continuous").select("region", "cutoff_us"), "region").where("end_us > cutoff_us").drop("cutoff_us")


def bridged_union(base: DataFrame, polled: DataFrame, status: DataFrame) -> DataFrame:
    columns = ["region", "start_us", "end_us"]
    return intervals.islands(base.select(*columns).unionByName(bridged(polled, status).select(*columns)), ["region"])


def status_kept(old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """Region states after a poll: a region that the poll lacks keeps its values and counts as not continuous."""
    fresh = new.select("region", *[F.col(c).alias(f"new_{c}") for c in columns], F.lit(True).alias("polled"))
    rows = old.join(fresh, "region", "full")
    return rows.select("region", *[F.coalesce(f"new_{c}", c).alias(c) for c in columns], F.coalesce("polled", F.lit(False)).alias("continuous"))


def paired(marks: DataFrame, keys: list[str]) -> DataFrame:
    """Start marks with the next end mark; a repeated start is ignored, and so is an end without a start.

    At equal times an end comes before a start. ``marks`` have ``ts_us`` and ``kind`` (start or end).
    """
    order = Window.partitionBy(*keys).orderBy("ts_us", F.when(F.col("kind") == "end", 0).otherwise(1))
    rows = marks.select(*keys, "ts_us", "kind").distinct()
    rows = rows.withColumn("before", F.lag("kind").over(order))
    # the nearest end after a mark is the last one before it in the reversed order, so the frame only grows
    back = Window.partitionBy(*keys).orderBy(F.desc("ts_us"), F.when(F.col("kind") == "end", 1).otherwise(0))
    ends = F.last(F.when(F.col("kind") == "end", F.col("ts_us")), ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("end_us", ends).where("kind = 'start' and coalesce(before, 'end') = 'end' and end_us is not null")
    return rows.select(*keys, F.col("ts_us").alias("start_us"), "end_us").where("end_us > start_us")


def accepted_names(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """Rows whose embedded name is accepted for their region: the region's own, its group's, or one of ``aliases`` (region, name).

    A blank name falls back to ``group_name``, where rows have one, and is accepted if that is blank too.
    Names are compared by ``name_key``.
    """
    group = F.col("group_name") if "group_name" in rows.columns else F.lit(None).cast("string")
    filled = lambda c: F.nullif(F.trim(c), F.lit(""))
    own = words.name_key(F.coalesce(filled(F.col("name")), filled(group)))
    names = aliases.select("region", words.name_key(F.col("name")).alias("__key")).distinct().withColumn("__known", F.lit(True))
    met = rows.withColumn("__key", own).join(names, ["region", "__key"], "left")
    good = F.col("__key").isNull() | F.col("__known") | (F.col("__key") == words.name_key(F.col("region").cast("string"))) | (F.col("__key") == words.name_key(group))
    return met.where(F.coalesce(good, F.lit(False))).select(*rows.columns)


def coverage(required: DataFrame, covered: DataFrame) -> DataFrame:
    """Counts of required, covered and uncovered regions, in one row."""
    rows = required.join(covered.select("region").distinct().withColumn("has", F.lit(True)), "region", "left")
    return rows.agg(F.count("*").alias("required"), F.count_if(F.col("has")).alias("covered"), F.count_if(F.col("has").isNull()).alias("uncovered"))


def receipts(polled: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Capture receipts: continuous where the first completed start is not after the previous check.

    ``polled``: key, source, start_us, captured_us per page row; ``checkpoints``: key, source, checked_us. The clock is
    the oldest page (``check_us``, by which freshness counts), the latest one is that of the export (``export_us``); a first capture only begins a series; the checkpoint moves only if the capture is continuous.
    """
    rows = polled.groupBy("key", "source").agg(F.min("captured_us").alias("check_us"), F.max("captured_us").alias("export_us"), F.min("start_us").alias("first_us"), F.count("start_us").alias("completed"))
    rows = rows.join(checkpoints, ["key", "source"], "left")
    good = F.coalesce((F.col("first_us") <= F.col("checked_us")) & (F.col("checked_us") <= F.col("check_us")), F.lit(False))
    after = F.when(F.col("checked_us").isNull() | good, F.col("check_us")).otherwise(F.col("checked_us"))
    return rows.withColumns({"continuous": good, "next_us": after})


def receipt_violations(told: DataFrame, polled: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """(key, source, reason): what an independent look at the captured pages finds wrong with receipts.

    ``told``: key, source, check_us, continuous, next_us. ``polled``: the rows that ``receipts`` reads, with
    ``started_us`` of each page's request and ``intact``, whether its body has the declared hash.
    """
    pages = polled.groupBy("key", "source").agg(F.min(F.coalesce("intact", F.lit(False))).alias("intact"), F.max(F.col("captured_us") < F.col("started_us")).alias("back"))
    own = receipts(polled, checkpoints).select("key", "source", *[F.col(c).alias(f"own_{c}") for c in ("check_us", "continuous", "next_us")])
    rows = told.join(pages.join(own, ["key", "source"]), ["key", "source"], "left")
    reasons = F.array_compact(F.array(
        F.when(F.col("intact").isNull(), "no pages"), F.when(~F.col("intact"), "body changed"), F.when(F.col("back"), "captured before its request"),
        F.when(F.col("check_us") != F.col("own_check_us"), "other clock"), F.when(F.col("continuous") != F.col("own_continuous"), "other continuity"),
        F.when(F.col("next_us") != F.col("own_next_us"), "other checkpoint")))
    return rows.select("key", "source", F.explode(reasons).alias("reason"))
