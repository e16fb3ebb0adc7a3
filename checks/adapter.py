"""Support messages derived from the ``events`` table, for queries, tests and the benchmark.

Every event becomes one message; reply pointers and texts follow from the event id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.scale import spread

CUSTOMER_TEXTS = [
    "@Acme my bill is wrong, I was charged twice https://t.co/ab1 #billing",
    "I can't access my account,   login fails with wrong password",
    "The API server returns error 500, still not working @Acme",
    "This is terrible, worst service, I'm so frustrated and angry",
    "Thanks so much, it is working now, all set!",
    "Thank you, the problem is gone and everything is fine",
    "URGENT: system is down, need this fixed asap",
    "This is important, I have a deadline, please reply quickly",
    "No rush, just wondering how to export my invoice",
    "I don't understand what you mean, please explain",
    "Could you please help when possible? I'd appreciate it",
    "Still waiting, how long will this take? hours ago I asked again",
    "I want to speak to a manager, escalate this now",
    "First time here, never used this feature before",
    "https://t.co/only",
    "I understand, makes sense, will try. Great support \U0001f44d",
]

AGENT_TEXTS = [
    "@Cust We're here to help. Please DM us your account number. ^KF",
    "@Cust We have escalated this to our billing team",
    "@Cust Glad that is resolved! Thanks for your patience",
    "@Cust Sorry for the trouble. Is the issue still happening?",
    "@Cust Please restart the device and let us know",
    "@Cust We understand your frustration, we will get back to you",
    "@Cust Your refund was issued, the payment will post in 3 days",
    "@Cust Can you share the error code? https://t.co/help",
]


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages as a feed export holds them: ids and flags as text, parent ids with a decimal point."""
    event, block, pos = F.col("event_id"), F.col("block"), F.col("pos")
    parent = (
        F.when((pos == 0) | (block % 7 == 3), F.lit(None))
        .when(pos == 3, block * 6 + 1)
        .when((pos == 4) & (block % 4 == 0), F.lit(1000000000) + event)
        .otherwise(event - 1)
    )
    customer = F.array(*map(F.lit, CUSTOMER_TEXTS))
    agent = F.array(*map(F.lit, AGENT_TEXTS))
    inbound = pos % 2 == 0
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    return (
        spread(events, "event_id")
        .withColumn("block", F.floor(event / 6))
        .withColumn("pos", event % 6)
        .select(
            event.cast("string").alias("tweet_id"),
            F.when(inbound, (block + 100000).cast("string"))
            .otherwise(F.concat(F.lit("Support"), (block % 5).cast("string")))
            .alias("author_id"),
            F.when(inbound, F.lit("True")).otherwise(F.lit("False")).alias("inbound"),
            F.col("ts").cast("timestamp").alias("created_at"),
            F.when(inbound, F.element_at(customer, ((event * 7 + block * 3) % 16 + 1).cast("int")))
            .otherwise(F.element_at(agent, ((event * 5 + block) % 8 + 1).cast("int")))
            .alias("text"),
            F.lit(None).cast("string").alias("response_tweet_id"),
            F.concat(parent.cast("bigint").cast("string"), F.lit(".0")).alias("in_response_to_tweet_id"),
        )
    )
