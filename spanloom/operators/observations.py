"""Deduplication of observations across and inside batches, and references between tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions import words


def canonical(rows: DataFrame, fields: list[str], context: list[str]) -> DataFrame:
    """Rows with hashes of their canonical fields and of their context fields."""
    return rows.withColumn("payload", words.canonical_hash(*map(F.col, sorted(fields)))).withColumn("context", words.canonical_hash(*map(F.col, sorted(context))))


def classed(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """``class`` of each row with ``payload`` and ``context``: FIRST, EXACT or EQUIVALENT copies of it, or CONFLICT."""
    turn = Window.partitionBy(*key).orderBy(*order)
    first = lambda c: F.first(c).over(turn)
    kind = (F.when(F.row_number().over(turn) == 1, "FIRST").when(F.col("payload") != first("payload"), "CONFLICT")
            .when(F.col("context") == first("context"), "EXACT").otherwise("EQUIVALENT"))
    return rows.withColumn("class", kind)


def repeated_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def dangling(references: DataFrame, observations: DataFrame, key: list[str]) -> DataFrame:
    """References to observations that do not exist."""
    return references.join(observations.select(*key).distinct(), key, "left_anti")


def referring(references: DataFrame, duplicates: DataFrame, key: list[str], episode: str) -> DataFrame:
    """The episodes that refer to each duplicated observation."""
    return references.join(duplicates.select(*key).distinct(), key).groupBy(*key).agg(F.array_sort(F.collect_set(episode)).alias("episodes"))
