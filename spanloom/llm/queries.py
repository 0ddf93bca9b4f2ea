"""The registered queries of this subpackage, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import language, licence, mixing, neighbours, ngram_lm, packing, passages, quality, rules, simhash, spelling, syncmers, turns


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprinted(_table(spark, sf_dir, "documents"))


def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated(_table(spark, sf_dir, "documents")).drop("mark")


def op3_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.scored(_table(spark, sf_dir, "documents"))


def op4_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.linked(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"), ["doc_id"])


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), packing.default_tokenizer())


def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.hamming_groups(_table(spark, sf_dir, "documents"), shingle=3, tau=2)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(_table(spark, sf_dir, "documents"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licence.scan(_table(spark, sf_dir, "documents"))
    return found.selectExpr("doc_id", "place", "licence", "array_join(sentences, '|') AS sentences")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.report(_table(spark, sf_dir, "conversations"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.filtered(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("broken", "|").alias("broken"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_syncmer_fingerprints": op1_syncmer_fingerprints,
    "op2_repeated_passages": op2_repeated_passages,
    "op3_ngram_scores": op3_ngram_scores,
    "op4_embedding_links": op4_embedding_links,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_source_mixing": op6_source_mixing,
    "op7_packing": op7_packing,
    "op8_simhash_groups": op8_simhash_groups,
    "op9_language_id": op9_language_id,
    "op10_licence_scan": op10_licence_scan,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_quality_rules": op12_quality_rules,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL: dict[str, str] = {}
