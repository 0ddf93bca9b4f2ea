"""Structured Streaming forms of the ingest operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from spanloom.operators import ingest
from spanloom.sources.sinks import KeyedTable, VersionedTable, stream_name

OPEN_HOURS = 36


def _pair(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        (start,) = state.get
        state.remove()
        yield pd.DataFrame({"key": [key[0]], "start_us": [start], "end_us": pd.array([None], dtype="Int64"), "expired": [True]})
        return
    rows = pd.concat(list(frames), ignore_index=True).drop_duplicates()
    rows["turn"] = (rows["kind"] == "start").astype(int)
    start = state.get[0] if state.exists else None
    out = []
    for ts, kind in rows.sort_values(["ts_us", "turn"])[["ts_us", "kind"]].itertuples(index=False):
        if kind == "start" and start is None:
            start = int(ts)
        elif kind == "end" and start is not None and ts > start:
            out.append((key[0], start, int(ts), False))
            start = None
    if start is None:
        if state.exists:
            state.remove()
    else:
        state.update((start,))
        limit = start // 1000 + OPEN_HOURS * 3_600_000
        state.setTimeoutTimestamp(max(limit, state.getCurrentWatermarkMs() + 1))
    if out:
        yield pd.DataFrame(out, columns=["key", "start_us", "end_us", "expired"]).astype({"end_us": "Int64"})


def paired(marks: DataFrame) -> DataFrame:
    """Pairs of start and end marks as they arrive. ``marks`` stream: key string, ts timestamp, kind (start or end).

    State is one open start per key. A start that no end follows within 36 hours of event time comes out
    without an end, marked as expired; marks later than the watermark of 36 hours are dropped by the engine.
    """
    rows = marks.withWatermark("ts", f"{OPEN_HOURS} hours").select("key", "ts", F.unix_micros("ts").alias("ts_us"), "kind")
    return rows.groupBy("key").applyInPandasWithState(
        _pair, "key string, start_us long, end_us long, expired boolean", "start_us long", "append", GroupStateTimeout.EventTimeTimeout
    )


def _upserted(store: DataFrame | None, batch: DataFrame, key: list[str]) -> DataFrame:
    if store is None:
        store = batch.limit(0).withColumn("first_fetched_us", F.col("fetched_us"))
    return ingest.upserted(store, batch, key)


def upsert_into(table: VersionedTable | KeyedTable, key: list[str]):
    """A ``foreachBatch`` function that merges polled rows into a table by key, once for each batch.

    A ``KeyedTable`` of that key rewrites only the buckets that the batch has keys in.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        if isinstance(table, KeyedTable):
            table.merge(batch, lambda old, new: _upserted(old, new, key), epoch, stream_name(batch))
        else:
            table.replace(_upserted(table.current(), batch, key), epoch, stream_name(batch))

    return merge


def receipts_into(table: VersionedTable, receipts: VersionedTable):
    """A ``foreachBatch`` function for captures: receipts of the batch, then the checkpoints that they move."""

    def record(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        stream = stream_name(batch)
        before = table.current()
        if before is None:
            before = spark.createDataFrame([], "key string, source string, checked_us long")
        # a repeated batch finds its receipts written, and takes the checkpoints from them
        receipts.replace(ingest.receipts(batch, before), epoch, stream)
        done = receipts.current().select("key", "source", F.col("next_us").alias("new"))
        table.replace(before.join(done, ["key", "source"], "full").select("key", "source", F.coalesce("new", "checked_us").alias("checked_us")), epoch, stream)

    return record


def parents_first(table: KeyedTable):
    """A ``foreachBatch`` function that keeps children until their parent comes.

    A batch has ``kind`` (parent or child), the table's key, ``at_us`` and other columns. The table holds parents, children that
    have exactly one, and waiting children, all of one key in one bucket and committed together, so a child that
    comes before its parent, by a batch or by a restart, is placed when the parent comes. Nothing is dropped:
    ``waiting`` tells which are overdue.
    """

    def settle(old: DataFrame | None, batch: DataFrame) -> DataFrame:
        rows = batch if old is None else old.withColumn("kind", F.when(F.col("kind") == "parent", "parent").otherwise("child")).unionByName(batch)
        # a parent that is told again is one parent; children are kept as often as they come
        parents = rows.where("kind = 'parent'").groupBy(*table.key).agg(F.max(F.struct("at_us", *[c for c in rows.columns if c not in {*table.key, "at_us", "kind"}])).alias("row"))
        parents = parents.select(*table.key, F.lit("parent").alias("kind"), "row.*").select(rows.columns)
        known = parents.select(*[F.col(c).alias(f"p_{c}") for c in table.key], F.lit(True).alias("known"))
        same = F.lit(True)
        for c in table.key:
            same &= F.col(c).eqNullSafe(F.col(f"p_{c}"))
        children = rows.where("kind <> 'parent'").join(known, same, "left")
        children = children.withColumn("kind", F.when(F.col("known"), "child").otherwise("waiting")).select(rows.columns)
        return parents.unionByName(children)

    def write(batch: DataFrame, epoch: int) -> None:
        table.merge(batch, settle, epoch, stream_name(batch))

    return write


def waiting(table: KeyedTable, now_us: Column, patience_us: int = OPEN_HOURS * 3_600_000_000) -> DataFrame:
    """Children without a parent so far, with ``overdue``: waiting for longer than ``patience_us``."""
    rows = table.current().where("kind = 'waiting'").drop("kind")
    return rows.withColumn("overdue", now_us - F.col("at_us") > patience_us)
