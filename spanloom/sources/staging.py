"""Tables that cut the lineage of loops: written to the folder that driver and executors share, and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of this session's own only where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not _own:
            _own.append(f"file://{tempfile.mkdtemp(prefix='spark-')}")
        folder = _own[0]
    return folder.rstrip("/")


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"


def staged(rows: DataFrame) -> DataFrame:
    """The rows as a written table."""
    path = new_path(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
