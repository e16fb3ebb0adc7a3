"""Message cleaning: types, ids, text, duplicates, empty messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import clean_id, clean_text, parse_time
from threadloom.operators.scale import one_per_key
from threadloom.schemas import POSITION

_MESSAGE_COLUMNS = [
    "tweet_id",
    "author_id",
    "inbound",
    "created_at",
    "text",
    "response_tweet_id",
    "in_response_to_tweet_id",
]


def _flag(column_type: str):
    if column_type == "boolean":
        return F.coalesce("inbound", F.lit(True))
    return F.coalesce(F.trim(F.col("inbound").cast("string")).try_cast("boolean"), F.lit(True))


def _moment(column_type: str):
    if column_type.startswith("timestamp"):
        return F.col("created_at").cast("timestamp")
    return parse_time(F.col("created_at"))


def normalise_types(raw: DataFrame, *also: str) -> DataFrame:
    """Typed columns; ids on both sides of a reply go through the same normaliser so that they match."""
    kinds = dict(raw.dtypes)
    return raw.select(
        clean_id(F.col("tweet_id").cast("string")).alias("tweet_id"),
        F.coalesce(F.col("author_id").cast("string"), F.lit("unknown")).alias("author_id"),
        _flag(kinds["inbound"]).alias("inbound"),
        _moment(kinds["created_at"]).alias("created_at"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        clean_id(F.col("response_tweet_id").cast("string")).alias("response_tweet_id"),
        clean_id(F.col("in_response_to_tweet_id").cast("string")).alias("in_response_to_tweet_id"),
        *also,
    )


def _reject_reason(message_id, created_at):
    return F.when(message_id == "", F.lit("missing_message_id")).when(
        created_at.isNull(), F.lit("bad_created_at")
    )


def usable(typed: DataFrame) -> DataFrame:
    return typed.where(_reject_reason(F.col("tweet_id"), F.col("created_at")).isNull())


def sorted_out(raw: DataFrame) -> DataFrame:
    """Every raw row typed, with ``reject_reason`` (null for messages) and, for the others, the raw row itself.

    A column ``feed_position``, which says where the row stands in the feed, is kept.
    """
    also = [name for name in raw.columns if name == POSITION]
    kept = raw.withColumn("raw", F.struct(*[name for name in raw.columns if name != POSITION]))
    typed = normalise_types(kept, "raw", *also)
    reason = _reject_reason(F.col("tweet_id"), F.col("created_at"))
    return typed.withColumn("reject_reason", reason).withColumn("raw", F.when(F.col("reject_reason").isNotNull(), F.col("raw")))


def rejected(rows: DataFrame) -> DataFrame:
    """Of sorted-out rows, those that cannot become messages, as they came and with the reason."""
    return rows.where(F.col("reject_reason").isNotNull()).select("raw.*", "reject_reason")


def rejects(raw: DataFrame) -> DataFrame:
    """Raw rows that cannot become messages, with the reason."""
    return rejected(sorted_out(raw))


def clean_texts(messages: DataFrame) -> DataFrame:
    """Texts are cleaned in a row of one, past which no filter moves: a test of the clean text would clean it once more."""
    return messages.withColumn("text", F.explode(F.array(clean_text(F.col("text")))))


def drop_duplicates(messages: DataFrame, then=None, keep: str = "earliest") -> DataFrame:
    """One row per message id. ``then`` prepares the texts on the way.

    ``keep`` says which: the ``earliest``, ties broken by content, or the ``first`` in the order of the feed, which needs the
    column ``feed_position``: files by name, within a file as they stand there.
    """
    if keep not in ("earliest", "first"):
        raise ValueError(f"unknown choice {keep!r}")
    rest = ["created_at", "author_id", "inbound", "text", "response_tweet_id", "in_response_to_tweet_id"]
    if keep == "first":
        rest.insert(0, POSITION)
    return one_per_key(messages.select("tweet_id", *rest), "tweet_id", rest, then=then).select(*_MESSAGE_COLUMNS)


def drop_empty(messages: DataFrame) -> DataFrame:
    return messages.where(F.length("text") > 0)


def cleaned(typed: DataFrame, keep: str = "earliest") -> DataFrame:
    """Typed messages with clean texts, one per id, without empty ones."""
    return drop_duplicates(typed, clean_texts, keep).transform(drop_empty)


def observed_figures() -> list[Column]:
    """Figures of the cleaning report that a job observes on messages while it writes them."""
    return [F.count(F.lit(1)).alias("clean_rows"), F.count_if(F.col("in_response_to_tweet_id") != "").alias("messages_with_parent")]


def clean_messages(raw: DataFrame) -> DataFrame:
    """The whole cleaning step. Time order is a property of sinks, so no global sort happens here."""
    return cleaned(usable(normalise_types(raw)))


def in_time_order(messages: DataFrame) -> DataFrame:
    return messages.orderBy("created_at", "tweet_id")


def replies(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("in_response_to_tweet_id") != "")


def cleaning_report(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Removed rows, replies, distinct parents referenced."""
    is_reply = F.col("in_response_to_tweet_id") != ""
    before = raw.agg(F.count("*").alias("raw_rows"))
    after = cleaned.agg(
        F.count("*").alias("clean_rows"),
        F.count_if(is_reply).alias("messages_with_parent"),
        F.count_distinct(F.when(is_reply, F.col("in_response_to_tweet_id"))).alias("parents_referenced"),
    )
    both = before.unionByName(after, allowMissingColumns=True).agg(
        *[F.max(name).alias(name) for name in before.columns + after.columns]
    )
    return both.withColumn("removed_rows", F.col("raw_rows") - F.col("clean_rows"))


def link_sample(cleaned: DataFrame, rows: int = 5) -> DataFrame:
    """The first reply links in time order, for the cleaning report."""
    return (
        replies(cleaned)
        .orderBy("created_at", "tweet_id")
        .select("tweet_id", "in_response_to_tweet_id")
        .limit(rows)
    )
