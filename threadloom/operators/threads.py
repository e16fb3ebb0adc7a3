"""Thread reconstruction from parent pointers.

Everything up to the final join works on a narrow ``(tweet_id, parent_id, created_at)`` table. Pointers are doubled
only among messages that have replies; a message without replies takes the root of its parent in one last lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.operators.scale import HOT_ROWS, checkpointed, hot_keys, hot_threshold, lookup, ordered_index
from threadloom.schemas import GROUPED_COLUMNS

# Text of a conversation is put together from blocks of this many messages; only inside, results do not depend on it.
BLOCK_MESSAGES = 5_000


def edges(messages: DataFrame) -> DataFrame:
    """``(tweet_id, parent_id, created_at)``; a self-reply has no parent."""
    parent = F.col("in_response_to_tweet_id")
    linked = ~parent.isin("", "nan", "None") & (parent != F.col("tweet_id"))
    return messages.select("tweet_id", F.when(linked, parent).alias("parent_id"), "created_at")


def _popular_parents(replied: DataFrame, hot_rows: int) -> DataFrame | None:
    """Parent ids with very many replies, if any. The threshold rises with the table, so there are few of them."""
    counted = replied.groupBy("in_response_to_tweet_id").agg(F.count("*").alias("replies"))
    replies, extent = checkpointed(counted, total=F.sum("replies"), largest=F.max("replies"))
    threshold = hot_threshold(extent["total"], hot_rows)
    if extent["largest"] <= threshold:
        return None
    return replies.where(F.col("replies") > threshold).select("in_response_to_tweet_id")


def parents(messages: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each reply with the record of the message it answers (null when that message is absent)."""
    found = messages.select(
        F.col("tweet_id").alias("in_response_to_tweet_id"),
        F.col("author_id").alias("parent_author_id"),
        F.col("created_at").alias("parent_created_at"),
    )
    replied = messages.where(F.col("in_response_to_tweet_id") != "")
    return lookup(replied, found, "in_response_to_tweet_id", "tweet_id", _popular_parents(replied, hot_rows))


def orphans(messages: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Replies whose parent is not in the data."""
    known = messages.select(F.col("tweet_id").alias("in_response_to_tweet_id"), F.lit(True).alias("known"))
    replied = messages.where(F.col("in_response_to_tweet_id") != "")
    found = lookup(replied, known, "in_response_to_tweet_id", "tweet_id", _popular_parents(replied, hot_rows))
    return found.where(F.col("known").isNull()).drop("known")


def _progress() -> dict[str, Column]:
    return {"finished": F.count_if("settled"), "open": F.count_if(~F.col("settled"))}


def _roots_of_parents(links: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """``(node, root_id)`` for every message with replies, and the parent ids with very many replies, if any."""
    counted = links.where(F.col("parent_id").isNotNull()).groupBy("parent_id").agg(F.count("*").alias("replies"))
    replies, extent = checkpointed(counted, total=F.sum("replies"), largest=F.max("replies"))
    threshold = hot_threshold(extent["total"], hot_rows)
    hot = None
    if extent["largest"] > threshold:
        # Counted over all replies, so that a popular parent missing from the data is among them.
        hot = replies.where(F.col("replies") > threshold).select("parent_id")
    nodes, _ = checkpointed(
        links.join(replies.select(F.col("parent_id").alias("node")), F.col("tweet_id") == F.col("node")).select(
            "node", "parent_id"
        )
    )
    exists = nodes.select(F.col("node").alias("parent_id"), F.lit(True).alias("linked"))
    state, counts = checkpointed(
        lookup(nodes, exists, "parent_id", "node", hot).select(
            "node",
            F.when(F.col("linked"), F.col("parent_id")).otherwise(F.col("node")).alias("pointer"),
            F.col("linked").isNull().alias("settled"),
        ),
        **_progress(),
    )
    done, active = state.where("settled"), state.where("NOT settled")
    # One round replaces every open pointer by its target's pointer. A round that settles nothing leaves only cycles.
    progress = True
    while counts["open"] and progress:
        targets = done.unionByName(active).select(
            F.col("node").alias("pointer"), F.col("pointer").alias("next"), F.col("settled").alias("reached")
        )
        busy = hot_keys(active, "pointer", counts["open"], hot_rows)
        state, counts = checkpointed(
            lookup(active, targets, "pointer", "node", busy).select(
                "node", F.col("next").alias("pointer"), F.col("reached").alias("settled")
            ),
            **_progress(),
        )
        progress = counts["finished"] > 0
        done, active = done.unionByName(state.where("settled")), state.where("NOT settled")
    roots = done.select("node", F.col("pointer").alias("root_id"))
    if counts["open"]:
        ring = nodes.join(active.select("node"), "node", "left_semi").select("node", "parent_id")
        roots = roots.unionByName(_cycle_roots(ring, counts["open"], hot_rows))
    return roots, hot


def _cycle_roots(ring: DataFrame, rows: int, hot_rows: int) -> DataFrame:
    """Nodes on, or leading into, a cycle: all take the smallest id on that cycle."""
    state = ring.select("node", F.col("parent_id").alias("pointer"), F.least("node", "parent_id").alias("smallest"))
    covered = 1
    while True:
        state, _ = checkpointed(state)
        targets = state.select(
            F.col("node").alias("pointer"), F.col("pointer").alias("next"), F.col("smallest").alias("beyond")
        )
        ahead = lookup(state, targets, "pointer", "node", hot_keys(state, "pointer", rows, hot_rows))
        if covered >= rows:
            # The pointer now lies on the cycle and its own minimum has gone all the way round.
            return ahead.select("node", F.col("beyond").alias("root_id"))
        state = ahead.select("node", F.col("next").alias("pointer"), F.least("smallest", "beyond").alias("smallest"))
        covered *= 2


def thread_roots(messages: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(tweet_id, created_at, root_id)``: the thread each message belongs to."""
    links, _ = checkpointed(edges(messages))
    known, hot = _roots_of_parents(links, hot_rows)
    answers = known.select(F.col("node").alias("parent_id"), "root_id")
    return lookup(links, answers, "parent_id", "tweet_id", hot).select(
        "tweet_id", "created_at", F.coalesce("root_id", "tweet_id").alias("root_id")
    )


def thread_sizes(roots: DataFrame) -> DataFrame:
    """One row per thread: its size and first moment."""
    return roots.groupBy("root_id").agg(F.count("*").alias("size"), F.min("created_at").alias("started_at"))


def conversation_ids(sizes: DataFrame) -> DataFrame:
    """Threads of two or more messages, numbered 1, 2, 3, ... by (first moment, root id)."""
    kept = sizes.where(F.col("size") > 1)
    return ordered_index(kept, ["started_at", "root_id"], "rank").select(
        "root_id", (F.col("rank") + 1).alias("conversation_id"), "size", "started_at"
    )


def sequence_numbers(roots: DataFrame, conversations: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(tweet_id, conversation_id, sequence_number)`` with positions from 0 in (created_at, tweet_id) order.

    Ordinary conversations are ranked by a window. Those above the hot threshold, at most MAX_HOT_KEYS of them, are
    ranked across range partitions instead, because a window would put each of them into one task.
    """
    numbered = conversations.select("root_id", "conversation_id")
    extent = conversations.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("rows"), F.coalesce(F.max("size"), F.lit(0)).alias("largest")
    ).first()
    threshold = hot_threshold(extent["rows"], hot_rows)
    ordinary, parts = roots, []
    if extent["largest"] > threshold:
        hot = numbered.join(conversations.where(F.col("size") > threshold).select("root_id"), "root_id", "left_semi")
        ordinary = roots.join(F.broadcast(hot.select("root_id")), "root_id", "left_anti")
        ranked = ordered_index(
            roots.join(F.broadcast(hot), "root_id"), ["created_at", "tweet_id"], "sequence_number", ["conversation_id"]
        )
        parts.append(ranked.select("tweet_id", "conversation_id", F.col("sequence_number").cast("int")))
    in_thread = Window.partitionBy("root_id").orderBy("created_at", "tweet_id")
    result = ordinary.join(numbered, "root_id").select(
        "tweet_id", "conversation_id", (F.row_number().over(in_thread) - 1).alias("sequence_number")
    )
    for part in parts:
        result = result.unionByName(part)
    return result


def thread_index(messages: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Conversation id and position of every message that belongs to a stored conversation."""
    roots, _ = checkpointed(thread_roots(messages, hot_rows))
    return sequence_numbers(roots, conversation_ids(thread_sizes(roots)), hot_rows)


def group_messages(messages: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The grouped message table. Both sides have one row per message id, so this wide join cannot be skewed."""
    return (
        messages.join(thread_index(messages, hot_rows), "tweet_id")
        .withColumnRenamed("inbound", "is_customer")
        .withColumnRenamed("text", "message_text")
        .select(*GROUPED_COLUMNS)
    )


def with_part(grouped: DataFrame, part_messages: int) -> DataFrame:
    """Add the part of its conversation a message falls into."""
    return grouped.withColumn("part", F.expr(f"CAST(sequence_number DIV {part_messages} AS INT)"))


def nested_conversations(grouped: DataFrame, block_messages: int = BLOCK_MESSAGES) -> DataFrame:
    """Conversations as ordered arrays of message records, one row each; put together from blocks, as transcripts are."""
    record = F.struct("sequence_number", *[name for name in GROUPED_COLUMNS[1:] if name != "sequence_number"])
    blocks = (
        with_part(grouped, block_messages)
        .groupBy("conversation_id", "part")
        .agg(F.array_sort(F.collect_list(record)).alias("block"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("part", "block")))
    return blocks.groupBy("conversation_id").agg(F.flatten(F.transform(ordered, lambda x: x["block"])).alias("messages"))


def joined_lines(lines: DataFrame, separator: str, block_messages: int = BLOCK_MESSAGES) -> DataFrame:
    """One ``text`` per conversation from rows ``(conversation_id, sequence_number, line)``, and its number of lines.

    Blocks of lines are joined first and then the blocks, so what is sorted at a time is bounded and only the finished
    text, which the result itself holds, comes together in one place. Both steps share the rows' one partitioning.
    """
    blocks = with_part(lines, block_messages).groupBy("conversation_id", "part").agg(
        F.expr(f"listagg(line, '{separator}') WITHIN GROUP (ORDER BY sequence_number)").alias("block"),
        F.count("*").alias("n"),
    )
    return blocks.groupBy("conversation_id").agg(
        F.expr(f"listagg(block, '{separator}') WITHIN GROUP (ORDER BY part)").alias("text"), F.sum("n").alias("lines")
    )
