"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import mixing, packing, passages, quality, simhash
from spanloom.llm.shared import settled


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier, learned from the labels of these, rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    scored = quality.score(docs, quality.fit(docs, labels), docs.columns, into="__quality")
    return scored.where(F.col("__quality") >= quality.THRESHOLD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose five-word shingles are alike at 0.8."""
    return simhash.one_of_each(docs, shingle=5, similarity=0.8)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document has."""
    return passages.without_repeats(docs, threshold=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources have their weights."""
    return mixing.repeated(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise and pack."""
    return packing.packed(docs, packing.default_tokenizer())


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("passages", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the classifier nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = settled(docs)
    return docs
