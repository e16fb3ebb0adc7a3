"""Transcripts: the text form of a conversation, and the way back to its pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.operators.threads import BLOCK_MESSAGES, with_part

SEPARATOR = " | "
SEPARATOR_PATTERN = r" \| "


def role_label() -> Column:
    return F.when(F.col("is_customer"), F.lit("CUSTOMER: ")).otherwise(F.lit("AGENT: "))


def lines(grouped: DataFrame) -> DataFrame:
    """``(conversation_id, sequence_number, line)``: one labelled line per message."""
    return grouped.select(
        "conversation_id",
        "sequence_number",
        F.concat(role_label(), F.col("author_id"), F.lit(": "), F.col("message_text")).alias("line"),
    )


def structured_lines(grouped: DataFrame) -> DataFrame:
    """``lines`` with what the customer says in a column of its own, whatever separators and labels the texts hold."""
    said = F.when(F.col("is_customer"), F.trim("message_text")).alias("customer_message")
    return grouped.select(
        "conversation_id",
        "sequence_number",
        F.concat(role_label(), F.col("author_id"), F.lit(": "), F.col("message_text")).alias("line"),
        said,
    )


def _blocks(grouped: DataFrame, messages: int) -> DataFrame:
    labelled = with_part(grouped, messages).withColumn(
        "line", F.concat(role_label(), F.col("author_id"), F.lit(": "), F.col("message_text"))
    )
    return labelled.groupBy("conversation_id", "part").agg(
        F.expr(f"listagg(line, '{SEPARATOR}') WITHIN GROUP (ORDER BY sequence_number)").alias("full_conversation"),
        F.count("*").alias("message_count"),
        F.min("created_at").alias("start_time"),
        F.max("created_at").alias("end_time"),
    )


def transcripts(grouped: DataFrame, block_messages: int = BLOCK_MESSAGES) -> DataFrame:
    """Transcript, message count and time span, one row per conversation of any length.

    Messages are shuffled by conversation and block, so a conversation that holds most of them is joined by many tasks;
    then the blocks' texts are joined to the whole.
    """
    return (
        _blocks(grouped, block_messages)
        .groupBy("conversation_id")
        .agg(
            F.expr(f"listagg(full_conversation, '{SEPARATOR}') WITHIN GROUP (ORDER BY part)").alias("full_conversation"),
            F.sum("message_count").alias("message_count"),
            F.min("start_time").alias("start_time"),
            F.max("end_time").alias("end_time"),
        )
    )


def transcript_parts(grouped: DataFrame, part_messages: int) -> DataFrame:
    """Transcripts cut into parts of ``part_messages`` messages, a row for each (conversation_id, part)."""
    return _blocks(grouped, part_messages)


def first_transcripts(grouped: DataFrame, limit: int, id_order: str = "number") -> DataFrame:
    """Transcripts of the first ``limit`` conversations, ids compared as numbers or as text."""
    key = F.col("conversation_id").cast("string") if id_order == "text" else F.col("conversation_id")
    chosen = grouped.select("conversation_id").distinct().orderBy(key).limit(limit)
    return transcripts(grouped.join(chosen, "conversation_id", "left_semi"))


def lines_of_transcripts(texts: DataFrame, text: str = "full_conversation") -> DataFrame:
    """Pieces of given transcripts, in the shape ``lines`` produces.

    With a column ``part``, the rows of a conversation are parts of its transcript and positions continue across them.
    """
    cut = texts.withColumn("_pieces", F.split(text, SEPARATOR_PATTERN))
    earlier = F.lit(0)
    if "part" in texts.columns:
        before = Window.partitionBy("conversation_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        cut = cut.select("conversation_id", "_pieces", F.coalesce(F.sum(F.size("_pieces")).over(before), F.lit(0)).alias("_at"))
        earlier = F.col("_at")
    placed = cut.select("conversation_id", earlier.alias("_at"), F.posexplode("_pieces").alias("_place", "line"))
    return placed.select("conversation_id", (F.col("_at") + F.col("_place")).cast("int").alias("sequence_number"), "line")


def pieces(line: Column) -> Column:
    return F.split(line, SEPARATOR_PATTERN)


def customer_pieces(line: Column) -> Column:
    """Customer message texts inside a line: third ``:``-field of every piece that names a customer."""
    fields = F.transform(
        F.filter(pieces(line), lambda piece: F.contains(piece, F.lit("CUSTOMER:"))),
        lambda piece: F.split(piece, ":", 3),
    )
    return F.transform(F.filter(fields, lambda parts: F.size(parts) == 3), lambda parts: F.trim(F.get(parts, F.lit(2))))


def customer_messages(line_rows: DataFrame) -> DataFrame:
    """Customer messages, one row each, in conversation order."""
    return line_rows.select(
        "conversation_id",
        "sequence_number",
        F.posexplode(customer_pieces(F.col("line"))).alias("piece", "customer_message"),
    )
