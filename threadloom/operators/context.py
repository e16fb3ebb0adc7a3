"""What is known about the customer behind each unresolved conversation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import clock_text
from threadloom.operators.analysis import unresolved
from threadloom.operators.scale import HOT_ROWS, hot_threshold, lookup
from threadloom.operators.threads import BLOCK_MESSAGES, joined_lines

HISTORY_SEPARATOR = " ### "
_ANALYSIS_FIELDS = [
    "conversation_id",
    "is_resolved",
    "tags",
    "nature_of_request",
    "customer_sentiment",
    "urgency_level",
    "conversation_type",
    "customer_behavior",
]


def analysed_messages(analysis: DataFrame, grouped: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each message with the analysis of its conversation.

    Positions are dense, so a conversation above the hot threshold is one that has a message at that position. The
    threshold rises with the table, which bounds how many there can be.
    """
    fields = analysis.select(*_ANALYSIS_FIELDS).withColumn("analysed", F.lit(True))
    threshold = hot_threshold(grouped.count(), hot_rows)
    hot = grouped.where(F.col("sequence_number") == threshold).select("conversation_id")
    joined = lookup(grouped, fields, "conversation_id", "tweet_id", hot)
    return joined.where(F.col("analysed").isNotNull()).drop("analysed")


def conversation_edges(grouped: DataFrame) -> DataFrame:
    """First customer, latest message and time, and message count per conversation.

    Message ids are unique in the grouped table, so a plain count is the count of distinct messages. Only positions are
    aggregated; the two messages are then fetched by position, so no texts are sorted or combined.
    """
    from_customer = F.when(F.col("is_customer"), F.col("sequence_number"))
    edges = grouped.groupBy("conversation_id").agg(
        F.min(from_customer).alias("first_customer"),
        F.max("sequence_number").alias("last"),
        F.max("created_at").alias("latest_interaction"),
        F.count("*").alias("total_messages"),
    )
    customers = grouped.select("conversation_id", F.col("sequence_number").alias("first_customer"), F.col("author_id").alias("customer_id"))
    latest = grouped.select("conversation_id", F.col("sequence_number").alias("last"), F.col("message_text").alias("latest_message"))
    return (
        edges.join(customers, ["conversation_id", "first_customer"], "left")
        .join(latest, ["conversation_id", "last"])
        .select("conversation_id", "customer_id", "latest_message", "latest_interaction", "total_messages")
    )


def cohort_names(cohorts: DataFrame, members: DataFrame) -> DataFrame:
    """Names of the cohorts of each conversation, in id order; a conversation is in each cohort at most once."""
    named = members.join(F.broadcast(cohorts.select("cohort_id", "cohort_name")), "cohort_id")
    return named.groupBy("conversation_id").agg(
        F.expr("listagg(cohort_name, '; ') WITHIN GROUP (ORDER BY cohort_id)").alias("customer_cohorts"),
        F.count("*").alias("cohort_count"),
    )


def customer_context(analysis: DataFrame, grouped: DataFrame, cohorts: DataFrame, members: DataFrame) -> DataFrame:
    """One row per unresolved conversation: analysis fields, customer, latest message, cohorts, message count.

    Messages of other conversations are left out before anything is aggregated. The chat history, the only wide part,
    is joined by ``with_history`` where it is needed.
    """
    asked = unresolved(analysis).select(*_ANALYSIS_FIELDS)
    messages = grouped.join(asked.select("conversation_id"), "conversation_id", "left_semi")
    return (
        asked.join(conversation_edges(messages), "conversation_id")
        .join(cohort_names(cohorts, members), "conversation_id", "left")
        .withColumn("cohort_count", F.coalesce("cohort_count", F.lit(0).cast("bigint")))
    )


def with_history(
    context: DataFrame, grouped: DataFrame, *, fanout: bool = False, block_messages: int = BLOCK_MESSAGES
) -> DataFrame:
    """Add the chat history, one row per conversation of any length.

    Messages are shuffled once, by conversation: the join that keeps the wanted ones, both steps of putting their
    lines together, and the final join share that partitioning. ``fanout`` repeats each message, and the cohort names,
    once per cohort and message.
    """
    copies = F.greatest(F.col("cohort_count"), F.lit(1)).cast("int")
    line = F.concat(
        clock_text(F.col("created_at")), F.lit(" | "), F.col("author_id"), F.lit(": "), F.col("message_text")
    )
    lines = grouped.join(context.select("conversation_id", copies.alias("copies")), "conversation_id").select(
        "conversation_id",
        "sequence_number",
        (F.array_join(F.array_repeat(line, F.col("copies")), HISTORY_SEPARATOR) if fanout else line).alias("line"),
    )
    history = joined_lines(lines, HISTORY_SEPARATOR, block_messages).withColumnRenamed("text", "chat_history")
    joined = context.join(history, "conversation_id")
    if fanout:
        joined = joined.withColumn(
            "customer_cohorts",
            F.when(
                F.col("cohort_count") > 0,
                F.array_join(F.array_repeat("customer_cohorts", F.col("lines").cast("int")), "; "),
            ),
        )
    return joined.drop("lines")
