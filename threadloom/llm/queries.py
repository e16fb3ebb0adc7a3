"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadloom.llm import (
    conversation_trie,
    decontamination,
    embedding_whitening,
    html_text,
    language_id,
    lattice_lm,
    near_duplicates,
    packing,
    quality_classifier,
    quality_rules,
    reference_sql,
    token_counts,
    token_store,
    toxicity,
)
from threadloom.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.report(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.report(table(spark, sf_dir, "pages"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.report(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.report(table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.report(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.report(table(spark, sf_dir, "embeddings"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.report(table(spark, sf_dir, "conversations"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_token_counts,
        op2_html_text,
        op3_quality_classifier,
        op4_quality_rules,
        op5_token_store,
        op6_decontamination,
        op7_toxicity,
        op8_lattice_lm,
        op9_near_duplicates,
        op10_packing,
        op11_embedding_whitening,
        op12_conversation_trie,
        op13_language_id,
    )
}

#: Statements for those that SQL can express; learnt models, compression and packing are tested by other means.
ORACLES: dict[str, str] = {
    "op4_quality_rules": reference_sql.QUALITY_RULES,
    "op6_decontamination": reference_sql.DECONTAMINATION,
    "op9_near_duplicates": reference_sql.NEAR_DUPLICATES,
    "op12_conversation_trie": reference_sql.CONVERSATION_TRIE,
}
