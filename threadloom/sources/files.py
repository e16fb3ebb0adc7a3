"""File sources and sinks: message CSV in, tables as Parquet, recommendations as CSV out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.recommend import export_history
from threadloom.operators.threads import BLOCK_MESSAGES, with_part
from threadloom.schemas import RAW_CSV, RECOMMENDATION_COLUMNS
from threadloom.sources import feed
from threadloom.sources.store import Store

RAW = "raw_messages"
REJECTS = "raw_rejects"
GROUPED = "grouped_messages"
ANALYSIS = "conversation_analysis"
COHORTS = "customer_cohorts"
MEMBERS = "conversation_cohort_mapping"
RECOMMENDATIONS = "recommendations"
RECOMMENDATION_REJECTS = "recommendation_rejects"


def read_messages_csv(spark: SparkSession, path: str, multiline: bool | None = None, position: bool = False) -> DataFrame:
    """Raw messages, all columns as text, read by many tasks per file; see ``feed.read_csv``."""
    return feed.read_csv(spark, path, multiline, RAW_CSV, position)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as last published."""
    return Store(spark, folder).read(name)


def write_table(df: DataFrame, folder: str, name: str, key: str | None = None) -> DataFrame:
    """Replace a table and return it as stored; until it is complete, readers see the one before."""
    store = Store(df.sparkSession, folder)
    with store.transaction() as work:
        work.write(name, df, key)
    return store.read(name)


def with_load_time(messages: DataFrame) -> DataFrame:
    return messages.withColumn("created_timestamp", F.current_timestamp())


def store_messages(messages: DataFrame, folder: str) -> DataFrame:
    """The cleaned message table with its load time."""
    return write_table(with_load_time(messages), folder, RAW)


def clustered(grouped: DataFrame, block_messages: int = BLOCK_MESSAGES) -> DataFrame:
    """The grouped message table, rows of a conversation together and in order.

    Clustering by (conversation, part) bounds what one task writes. Readers profit: partial aggregates by conversation
    leave almost one row per conversation to shuffle.
    """
    return (
        with_part(grouped, block_messages)
        .repartition("conversation_id", "part")
        .sortWithinPartitions("conversation_id", "sequence_number")
        .drop("part")
    )


def store_grouped(grouped: DataFrame, folder: str, block_messages: int = BLOCK_MESSAGES) -> DataFrame:
    return write_table(clustered(grouped, block_messages), folder, GROUPED)


def upsert_analysis(records: DataFrame, folder: str) -> DataFrame:
    """Insert or replace analysis rows by conversation id; only the buckets that hold them are written."""
    store = Store(records.sparkSession, folder)
    with store.transaction() as work:
        work.upsert(ANALYSIS, records, "conversation_id")
    return store.read(ANALYSIS)


def clear_analysis(spark: SparkSession, folder: str, analysis: str, cohorts: str, members: str) -> None:
    """Empty the analysis and cohort tables, all three at once; the arguments are their schemas as DDL."""
    with Store(spark, folder).transaction() as work:
        for name, schema in ((ANALYSIS, analysis), (COHORTS, cohorts), (MEMBERS, members)):
            work.write(name, spark.createDataFrame([], schema))


def store_cohorts(cohorts: DataFrame, members: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both tables, published together."""
    store = Store(cohorts.sparkSession, folder)
    with store.transaction() as work:
        work.write(COHORTS, cohorts)
        work.write(MEMBERS, members)
    return store.read(COHORTS), store.read(MEMBERS)


def export_columns(recommendations: DataFrame) -> DataFrame:
    """The exported columns, with the history on one line and the status default filled in."""
    return recommendations.withColumns(
        {
            "issue_status": F.coalesce("issue_status", F.lit("pending_customer_reply")),
            "chat_history": export_history(F.coalesce("chat_history", F.lit(""))),
        }
    ).select(*RECOMMENDATION_COLUMNS)


def write_recommendations_csv(recommendations: DataFrame, path: str) -> bool:
    """All fields quoted, UTF-8, with header; nothing is written when there is nothing to write.

    An export that is there already is replaced when the new one is complete. Rows are counted as they are written: asking for
    them before would put all histories together twice.
    """
    spark, fresh, written = recommendations.sparkSession, f"{path.rstrip('/')}.{uuid.uuid4().hex}", Observation()
    rows = export_columns(recommendations).observe(written, F.count(F.lit(1)).alias("rows"))
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(fresh)
    made, place = (spark._jvm.org.apache.hadoop.fs.Path(name) for name in (fresh, path))
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not written.get["rows"]:
        files.delete(made, True)
        return False
    files.delete(place, True)
    if not files.rename(made, place):
        raise OSError(f"{fresh} could not be renamed to {path}")
    return True


def read_recommendations_csv(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{name} {'BIGINT' if name == 'conversation_id' else 'STRING'}" for name in RECOMMENDATION_COLUMNS)
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True)
    return reader.option("escape", '"').csv(path)
