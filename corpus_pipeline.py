"""From raw documents to packed training sequences: five stages, each stored before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadloom.llm import common, decontamination, near_duplicates, packing, quality_rules, toxicity


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, common.table(spark, sf_dir, "labels"))


def with_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.distinct_documents(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, common.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("quality rules", with_quality),
    ("MinHash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

#: Learnt scores and near-duplicate search are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from the documents table on."""
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir))
    return docs
