import pytest
from pyspark.sql import functions as F

from threadloom.operators import recommend

AS_OF = "2024-02-01 10:00:00"
FIELDS = ["customer_id", "conversation_id", "urgency_level", "channel", "send_time", "message", "reasoning", "issue_status"]
SCHEMA = ", ".join(f"{name} {'BIGINT' if name == 'conversation_id' else 'STRING'}" for name in FIELDS)


def frame(spark, *changes):
    base = {"customer_id": "42", "urgency_level": "low", "channel": "twitter_dm_reply",
            "send_time": "2024-02-01T10:30:05Z", "message": "Hi there", "reasoning": "r", "issue_status": "resolved"}
    rows = [{**base, "conversation_id": n, **change} for n, change in enumerate(changes)]
    return spark.createDataFrame([tuple(row[name] for name in FIELDS) for row in rows], SCHEMA)


def times(spark, as_of, *changes):
    made = recommend.with_send_time(frame(spark, *changes), as_of).orderBy("conversation_id")
    return [row.send_time for row in made.collect()]


def test_urgent_times(spark):
    urgent = {"urgency_level": "critical", "channel": "scheduling_phone_call"}
    for as_of, wanted in {
        "2024-02-01 08:59:59": "2024-02-01T09:00:00Z",
        "2024-02-01 09:00:00": "2024-02-01T10:00:00Z",
        "2024-02-01 17:59:30": "2024-02-01T18:59:30Z",
        "2024-02-01 18:00:00": "2024-02-02T09:00:00Z",
        "2024-02-03 19:00:00": "2024-02-04T09:00:00Z",  # Sunday is kept for a call
    }.items():
        assert times(spark, as_of, urgent) == [wanted]
    mail = {"urgency_level": "high", "channel": "email_reply"}
    assert times(spark, "2024-02-02 18:30:00", mail) == ["2024-02-05T09:00:00Z"]  # Saturday to Monday
    assert times(spark, "2024-02-04 11:00:07", mail) == ["2024-02-05T09:00:07Z"]


def test_preferred_hours_keep_seconds(spark):
    cases = [
        ("twitter_dm_reply", "2024-02-01T20:00:07Z", "2024-02-01T19:00:07Z"),
        ("twitter_dm_reply", "2024-02-01T19:59:07Z", "2024-02-01T19:59:07Z"),
        ("email_reply", "2024-02-01T18:30:01Z", "2024-02-01T17:00:01Z"),
        ("scheduling_phone_call", "2024-02-01T17:00:00Z", "2024-02-01T16:00:00Z"),
        ("scheduling_phone_call", "2024-02-01T08:59:59Z", "2024-02-01T09:00:59Z"),
        ("email_reply", "2024-02-03T12:00:09Z", "2024-02-05T09:00:09Z"),
        ("email_reply", "2024-02-04T23:00:00Z", "2024-02-05T09:00:00Z"),
        ("twitter_dm_reply", "2024-02-04T12:00:00+05:00", "2024-02-04T12:00:00Z"),
        ("twitter_dm_reply", "2024-02-04", "2024-02-04T09:00:00Z"),
        ("twitter_dm_reply", "soon", "2024-02-01T12:00:00Z"),
        ("twitter_dm_reply", "2024", "2024-02-01T12:00:00Z"),
        ("twitter_dm_reply", None, "2024-02-01T10:00:00Z"),
        ("fax", "2024-02-01T12:30:00Z", "2024-02-01T12:00:00Z"),
    ]
    got = times(spark, AS_OF, *[{"channel": channel, "send_time": asked} for channel, asked, _ in cases])
    assert got == [wanted for _, _, wanted in cases]


def messages(spark, *changes, fit=False):
    made = recommend.with_message(frame(spark, *changes), fit).orderBy("conversation_id")
    return [row.message for row in made.collect()]


def test_messages(spark):
    tweet, mail, call = "twitter_dm_reply", "email_reply", "scheduling_phone_call"
    signature, offer, ask = recommend.EMAIL_SIGNATURE, recommend.CALL_OFFER, recommend.CALL_TIME
    cases = [
        (tweet, "Hi you", "Hi you"), (tweet, "Hello you", "Hello you"), (tweet, "Sorry", "Hi 42, Sorry"),
        (tweet, "Dear you", "Hi 42, Dear you"),
        (mail, "Dear you", "Dear you" + signature), (mail, "Hello", "Hello" + signature),
        (mail, "Hi", "Dear 42,\n\nHi" + signature),
        (call, "We will CALL you", "We will CALL you" + ask), (call, "Sorry", "Sorry" + offer + ask),
        (tweet, "Hi" + "x" * 498, "Hi" + "x" * 498), (tweet, "Hi" + "x" * 499, "Hi" + "x" * 495 + "..."),
        (tweet, "x" * 500, "Hi 42, " + "x" * 500), ("fax", "Sorry", "Sorry"),
    ]
    got = messages(spark, *[{"channel": channel, "message": body} for channel, body, _ in cases])
    assert got == [wanted for _, _, wanted in cases]


def test_fit_leaves_room(spark):
    long = [{"channel": channel, "message": "y" * 2000} for channel in recommend.CHANNELS]
    limits = [limits["max_length"] for limits in recommend.CHANNELS.values()]
    assert [len(body) for body in messages(spark, *long, fit=True)] == limits
    assert all(len(body) > limit for body, limit in zip(messages(spark, *long), limits))


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, None), ({"customer_id": None}, "missing_customer_id"), ({"message": ""}, None),
        ({"reasoning": ""}, "missing_reasoning"), ({"issue_status": ""}, "missing_issue_status"),
        ({"channel": ""}, "missing_channel"), ({"channel": "fax"}, "bad_channel"),
        ({"issue_status": "odd"}, "bad_issue_status"), ({"message": "z" * 500}, "message_too_long"),
        ({"send_time": "junk"}, None), ({"message": None}, "missing_message"),
    ],
)
def test_validation(spark, change, reason):
    assert recommend.optimise(frame(spark, change), AS_OF).first().reject_reason == reason


def test_bad_time_text_is_rejected(spark):
    made = frame(spark, {"send_time": "junk"}).withColumn("reject_reason", recommend.reject_reason())
    assert made.first().reject_reason == "bad_send_time"


def test_rule_decisions(spark):
    rows = [
        ("high", "neutral", "polite"), ("low", "frustrated", "polite"), ("low", "angry", "technical"),
        ("low", "neutral", "technical"), ("medium", "technical", "polite"), ("medium", "positive", "polite"),
    ]
    context = spark.createDataFrame(
        [(n, "7", "billing", *row) for n, row in enumerate(rows)],
        "conversation_id BIGINT, customer_id STRING, nature_of_request STRING, urgency_level STRING, "
        "customer_sentiment STRING, customer_behavior STRING",
    )
    made = recommend.rule_recommendations(context, AS_OF).orderBy("conversation_id").collect()
    assert [row.channel for row in made] == ["scheduling_phone_call"] * 3 + ["email_reply"] * 2 + ["twitter_dm_reply"]
    assert [row.issue_status for row in made] == ["pending_customer_reply"] * 5 + ["resolved"]
    assert made[0].send_time == "2024-02-01T12:00:00Z"
    assert made[5].reasoning == "Twitter DM chosen for quick acknowledgment of medium priority billing issue."


def test_reports(spark):
    made = frame(spark, {}, {"channel": "email_reply", "message": "m" * 150, "reasoning": "r" * 200}, {}, {})
    assert {row.channel: row.recommendations for row in recommend.channel_distribution(made).collect()} == {
        "twitter_dm_reply": 3, "email_reply": 1,
    }
    sample = recommend.recommendation_sample(made).collect()
    assert len(sample) == 3 and sample[1].message == "m" * 100 + "..." and sample[1].reasoning == "r" * 150 + "..."
    shown = spark.range(1).select(recommend.export_history(F.lit("a ### b\nc\rd"))).first()[0]
    assert shown == "a | b | cd"
