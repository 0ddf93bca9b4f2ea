"""Outputs: delimited files, a nested document, event files, tables replaced as a whole, snapshots with a manifest."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import times
from spanloom.operators import proofs


def delimited(rows: DataFrame, path: str, columns: list[str]) -> None:
    rows.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def document(grains: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """One row with the JSON of published grains: name to (rows, columns to sort by). For calendar grains, whose
    number of rows is that of periods and cities, not of events."""
    spark = next(iter(grains.values()))[0].sparkSession
    out = spark.range(1).select(F.lit(1).alias("one"))
    for name, (rows, order) in sorted(grains.items()):
        rest = [c for c in rows.columns if c not in order]
        one = rows.agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias(name))
        out = out.join(F.broadcast(one))
    return out.select(F.to_json(F.struct(*sorted(grains))).alias("document"))


def event_file(rows: DataFrame, path: str) -> None:
    """The audit file of single events, with minutes as published."""
    minutes = times.round3((F.col("end_us") - F.col("start_us")) / (60 * times.SECOND))
    rows.select(times.iso(F.col("start_us")).alias("start"), times.iso(F.col("end_us")).alias("end"), minutes.alias("duration_minutes"), "source").write.mode("overwrite").json(path)


class _Pointed:
    """Versions of a folder, each committed by an empty file whose name says what it is."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 5):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), max(1, keep)
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._system = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _pointers(self) -> list[tuple[int, str, int]]:
        """(version, stream, epoch), in order; batch versions have no stream and epoch -1."""
        if not self._system.exists(self._path(f"{self.path}/pointers")):
            return []
        names = [f.getPath().getName().split("@") for f in self._system.listStatus(self._path(f"{self.path}/pointers"))]
        return sorted((int(v), stream, int(epoch)) for v, stream, epoch in names)

    def _version(self, epoch: int | None, stream: str) -> tuple[int, str, int, bool]:
        """The version to write with its stream and epoch, and whether that epoch has been written already."""
        pointers = self._pointers()
        if epoch is None:
            stream, epoch = "", -1
        else:
            stream = stream or "stream"
            done = [v for v, s, e in pointers if (s, e) == (stream, epoch)]
            if done:
                return done[0], stream, epoch, True
            if any(s == stream and e > epoch for _, s, e in pointers):
                raise ValueError(f"epoch {epoch} of {stream} comes after a later one; a stream that was begun anew needs a name of its own")
        return (pointers[-1][0] + 1 if pointers else 0), stream, epoch, False

    def _commit(self, version: int, stream: str, epoch: int) -> None:
        self._system.mkdirs(self._path(f"{self.path}/pointers"))
        self._system.create(self._path(f"{self.path}/pointers/{version:012d}@{stream}@{epoch}"), False).close()
        self._forget(self._pointers())

    def _forget(self, pointers: list[tuple[int, str, int]]) -> None:
        newest = {stream: version for version, stream, _ in pointers}
        for version, stream, epoch in pointers[: -self.keep]:
            self._drop(version)
            if newest[stream] != version:
                self._system.delete(self._path(f"{self.path}/pointers/{version:012d}@{stream}@{epoch}"), False)

    def _drop(self, version: int) -> None:
        self._system.delete(self._path(f"{self.path}/data/{version}"), True)


class VersionedTable(_Pointed):
    """A table that is replaced as a whole: a new version is written beside the old one, then a pointer is made.

    Readers see the old version or the new one. Versions count up by one. A pointer's name holds the version
    and, for a stream's batch, the stream and its epoch, so making it commits both at once: an epoch that is
    repeated does nothing, while one of another stream, or of a stream begun anew, is a batch of its own. Of
    versions older than the last ``keep`` the data go, and pointers but each stream's last.
    """

    def current(self) -> DataFrame | None:
        pointers = self._pointers()
        return self.spark.read.parquet(f"{self.path}/data/{pointers[-1][0]}") if pointers else None

    def replace(self, rows: DataFrame, epoch: int | None = None, stream: str = "") -> int:
        """Write a version; with an epoch, once for each epoch of ``stream``. Returns the version."""
        version, stream, epoch, done = self._version(epoch, stream)
        if not done:
            rows.write.mode("overwrite").parquet(f"{self.path}/data/{version}")
            self._commit(version, stream, epoch)
        return version


class KeyedTable(_Pointed):
    """A table dealt to ``buckets`` by the hash of its key, of which a batch rewrites only those that it has keys in.

    A version is a list of the buckets' folders, most of them of earlier versions; it is committed, with a stream's epoch,
    by one pointer as in ``VersionedTable``. What a batch writes grows with the buckets it touches, not with the table:
    ``buckets`` should be many times the keys of a batch, or the table's size over some 100 MB, whichever is more.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = 256, keep: int = 5):
        super().__init__(spark, path, keep)
        self.key, self.buckets = key, buckets

    def _listed(self, version: int) -> dict[str, int]:
        """Each bucket's version."""
        stream = self._system.open(self._path(f"{self.path}/lists/{version}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _rows(self, listed: dict[str, int]) -> DataFrame | None:
        if not listed:
            return None
        return self.spark.read.parquet(*[f"{self.path}/data/{v}/__bucket={b}" for b, v in sorted(listed.items())])

    def current(self) -> DataFrame | None:
        pointers = self._pointers()
        return self._rows(self._listed(pointers[-1][0])) if pointers else None

    def merge(self, batch: DataFrame, combine: Callable[[DataFrame | None, DataFrame], DataFrame], epoch: int | None = None, stream: str = "") -> int:
        """Replace the touched buckets' rows by ``combine(those rows, batch)``, once for each epoch. Returns the version.

        ``combine`` gets None where there are no rows yet; its result has the key.
        """
        version, stream, epoch, done = self._version(epoch, stream)
        if done:
            return version
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        touched = [str(r[0]) for r in batch.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets`` numbers
        listed = self._listed(version - 1) if version else {}
        old = self._rows({b: v for b, v in listed.items() if b in set(touched)})
        rows = combine(old, batch).withColumn("__bucket", bucket)
        rows.repartition("__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(f"{self.path}/data/{version}")
        there = {f.getPath().getName() for f in self._system.listStatus(self._path(f"{self.path}/data/{version}"))}
        listed = {b: v for b, v in listed.items() if b not in set(touched)} | {b: version for b in touched if f"__bucket={b}" in there}
        out = self._system.create(self._path(f"{self.path}/lists/{version}.json"), True)
        out.write(bytearray(json.dumps(listed).encode()))
        out.close()
        self._commit(version, stream, epoch)
        return version

    def _drop(self, version: int) -> None:
        """Let a version go: its list, and the folders that no kept version lists."""
        kept = [v for v, *_ in self._pointers()[-self.keep :]]
        used = {(b, v) for k in kept for b, v in self._listed(k).items()}
        path = self._path(f"{self.path}/lists/{version}.json")
        if self._system.exists(path):
            for b, v in self._listed(version).items():
                if (b, v) not in used:
                    self._system.delete(self._path(f"{self.path}/data/{v}/__bucket={b}"), True)
            self._system.delete(path, False)


def stream_name(batch: DataFrame) -> str:
    """The id of the streaming query that a ``foreachBatch`` function runs in: it lasts as long as its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"


def snapshot(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Write each table, and a manifest with its rows and SHA-256; the manifest is taken from what was written."""
    spark = next(iter(tables.values())).sparkSession
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}")
    written = proofs.manifest({n: spark.read.parquet(f"{path}/{n}") for n in tables})
    written.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return spark.read.json(f"{path}/manifest")


