"""Capture bundles as files: one JSON line for each bundle, in folders by kind of source.

A reader that asks for some sources opens only their folders (a partition filter), and bundles are read where they lie by
Spark's own file source, so any store that Spark reads will do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = "struct<url:string,started_at:string,captured_at:string,body_sha256:string,body_base64:string>"
BUNDLE = f"city string, checked_at string, claimed long, pages array<{PAGE}>"


def bundled(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Bundles (source_key, city, ..., pages) of ``pages``: the keys, url, started_at, captured_at and ``body`` (binary). A bundle is one
    capture, so it has few pages."""
    page = F.struct("url", "started_at", "captured_at", F.sha2("body", 256).alias("body_sha256"), F.base64("body").alias("body_base64"))
    return pages.groupBy(*keys).agg(F.array_sort(F.collect_list(page)).alias("pages"))


def write(bundles: DataFrame, path: str) -> None:
    bundles.write.mode("overwrite").partitionBy("source_key").json(path)


def read(spark: SparkSession, path: str, sources: list[str] | None = None) -> DataFrame:
    """(source_key, city, checked_at, claimed, page, url, started_at, captured_at, body_sha256, body_base64) of the bundles of ``sources``, or of all."""
    rows = spark.read.schema(f"{BUNDLE}, source_key string").json(path)
    if sources is not None:
        rows = rows.where(F.col("source_key").isin(sources))
    return rows.select("source_key", "city", "checked_at", "claimed", F.posexplode("pages").alias("page", "p")).select("source_key", "city", "checked_at", "claimed", "page", "p.*")
