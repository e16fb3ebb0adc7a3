"""Table schemas, as Spark DDL."""

RAW_TEXT_COLUMNS = [
    "tweet_id",
    "author_id",
    "inbound",
    "created_at",
    "text",
    "response_tweet_id",
    "in_response_to_tweet_id",
]

RAW_CSV = ", ".join(f"{name} STRING" for name in RAW_TEXT_COLUMNS)

#: Where a row stands in the feed: file, byte at which its range begins, number in the order of reading.
POSITION = "feed_position"

MESSAGES = (
    "tweet_id STRING, author_id STRING, inbound BOOLEAN, created_at TIMESTAMP, text STRING, "
    "response_tweet_id STRING, in_response_to_tweet_id STRING"
)

GROUPED_COLUMNS = [
    "conversation_id",
    "tweet_id",
    "author_id",
    "is_customer",
    "message_text",
    "created_at",
    "response_tweet_id",
    "in_response_to_tweet_id",
    "sequence_number",
]

RECORD_COLUMNS = [
    "is_resolved",
    "resolution_confidence",
    "tags",
    "nature_of_request",
    "customer_sentiment",
    "urgency_level",
    "conversation_type",
    "customer_behavior",
    "resolution_summary",
    "key_issues",
    "agent_performance",
]

RECOMMENDATION_COLUMNS = [
    "customer_id",
    "conversation_id",
    "channel",
    "send_time",
    "message",
    "reasoning",
    "issue_status",
    "chat_history",
]
