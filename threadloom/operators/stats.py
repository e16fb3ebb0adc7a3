"""Conversation statistics, selections and counts over the grouped message table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def conversation_stats(grouped: DataFrame) -> DataFrame:
    """Messages, first and last time and distinct authors per conversation."""
    return grouped.groupBy("conversation_id").agg(
        F.count("*").alias("message_count"),
        F.min("created_at").alias("start_time"),
        F.max("created_at").alias("end_time"),
        F.count_distinct("author_id").alias("participants"),
    )


def size_histogram(grouped: DataFrame) -> DataFrame:
    sizes = grouped.groupBy("conversation_id").agg(F.count("*").alias("messages"))
    return sizes.groupBy("messages").agg(F.count("*").alias("conversations")).orderBy("messages")


def basic_stats(messages: DataFrame, grouped: DataFrame) -> DataFrame:
    """One row: totals by kind and the average conversation size (0 when there is none)."""
    per_conversation = grouped.groupBy("conversation_id").agg(
        F.count("*").alias("size"), F.count_if("is_customer").alias("from_customer")
    )
    totals = per_conversation.agg(
        F.count("*").alias("total_conversations"),
        F.coalesce(F.sum("from_customer"), F.lit(0)).alias("customer_messages"),
        F.coalesce(F.sum(F.col("size") - F.col("from_customer")), F.lit(0)).alias("agent_messages"),
        F.coalesce(F.round(F.avg("size"), 2), F.lit(0.0)).alias("avg_messages_per_conversation"),
    )
    counted = messages.agg(F.count("*").alias("total_tweets"))
    names = counted.columns + totals.columns
    return counted.unionByName(totals, allowMissingColumns=True).agg(*[F.max(n).alias(n) for n in names])


def largest_conversations(grouped: DataFrame, limit: int = 10) -> DataFrame:
    """The size report: biggest conversations with their participant counts."""
    return (
        conversation_stats(grouped)
        .orderBy(F.desc("message_count"), "conversation_id")
        .limit(limit)
        .select("conversation_id", "message_count", "participants")
    )


def select_conversations(grouped: DataFrame, limit: int = 10, order_by: str = "row") -> DataFrame:
    """Ids of the first (``row``) or biggest (``size``) conversations; any other order means ``row``."""
    if order_by == "size":
        sizes = grouped.groupBy("conversation_id").agg(F.count("*").alias("size"))
        return sizes.orderBy(F.desc("size"), "conversation_id").limit(limit).select("conversation_id")
    return grouped.select("conversation_id").distinct().orderBy("conversation_id").limit(limit)


def messages_of(grouped: DataFrame, selected: DataFrame) -> DataFrame:
    """Messages of the selected conversations."""
    return grouped.join(selected, "conversation_id", "left_semi")


def conversations_with_messages(grouped: DataFrame, limit: int = 10, order_by: str = "row") -> DataFrame:
    chosen = select_conversations(grouped, limit, order_by)
    return messages_of(grouped, chosen).orderBy("conversation_id", "sequence_number")


def conversation_overview(grouped: DataFrame, limit: int = 10, order_by: str = "row") -> DataFrame:
    """Display figures for the selected conversations."""
    chosen = select_conversations(grouped, limit, order_by)
    return conversation_stats(messages_of(grouped, chosen)).orderBy("conversation_id")


def ingest_summary(messages: DataFrame, grouped: DataFrame) -> DataFrame:
    """Records processed and conversations created."""
    return basic_stats(messages, grouped).select(
        F.col("total_tweets").alias("records_processed"), F.col("total_conversations").alias("conversations_created")
    )


def ingest_figures(spark: SparkSession, messages: int, conversations: int) -> DataFrame:
    """The same from figures that are known already."""
    return spark.createDataFrame([(messages, conversations)], "records_processed BIGINT, conversations_created BIGINT")
