import json

import pytest
from pyspark.sql import functions as F

from threadloom.operators import analysis, context, model_exchange, recommend

GOOD = {"channel": "email_reply", "send_time": "2024-02-01T10:00:00Z", "message": "m", "reasoning": "r",
        "issue_status": "resolved"}


def replies(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "conversation_id BIGINT, response_text STRING")


@pytest.mark.parametrize(
    "given, wanted",
    [("  {} ", "{}"), ("```json\n{}\n```", "{}"), ("```{}```", "{}"), ("```json{}", "{}"), ("``` ```", ""),
     ("a```b", "a```b"), ("{}```\n", "{}"), ("```json```{}", "{}")],
)
def test_unfence(spark, given, wanted):
    assert spark.range(1).select(model_exchange.unfence(F.lit(given))).first()[0] == wanted


def test_analysis_replies(spark):
    full = {"is_resolved": True, "resolution_confidence": 0.7, "tags": ["a", "b"], "nature_of_request": "billing",
            "customer_sentiment": "positive", "key_issues": ["k"], "agent_performance": "good"}
    failed_texts = ['{"tags": ["x"', "plain words", '{"is_resolved": true} trailing', "['list']", "[1, 2]", '"text"',
                    "{'single': 'quotes'}", "", '{"a": 1} {"b": 2}', '{"a": 1}, {"b": 2}']
    rows = model_exchange.parse_analysis_replies(
        replies(spark, json.dumps(full), '{"agent_performance": "poor"}', '{"tags": null}', *failed_texts)
    ).orderBy("conversation_id").collect()
    assert rows[0].is_resolved and rows[0].tags == ["a", "b"] and rows[0].resolution_confidence == 0.7
    assert rows[0].resolution_summary is None and rows[0].urgency_level is None
    assert rows[1].tags == ["unanalyzed"] and rows[1].nature_of_request == "general" and not rows[1].is_resolved
    assert rows[1].agent_performance == "poor" and rows[1].customer_sentiment == "neutral"
    assert rows[2].tags == ["unanalyzed"]
    for text, row in zip(failed_texts, rows[3:]):
        assert row.tags == ["gemini_analysis_failed"] and row.resolution_summary == "Analysis failed", text


def test_merge(spark, grouped_of):
    made = analysis.analyse(grouped_of({n: [(True, "my bill")] for n in range(4)}))
    assert all(row.needs_llm for row in made.collect())
    parsed = model_exchange.parse_analysis_replies(
        replies(spark, '{"tags": ["t"], "resolution_summary": "s", "key_issues": ["k"], "agent_performance": "good", '
                       '"nature_of_request": "technical"}', "broken", "{}")
    )
    rows = model_exchange.merge_replies(made, parsed).orderBy("conversation_id").collect()
    assert rows[0].tags == ["t"] and rows[0].key_issues == ["k"] and rows[0].nature_of_request == "billing"
    assert rows[1].tags == ["gemini_analysis_failed"] and rows[1].agent_performance == "unknown"
    assert rows[2].tags == ["unanalyzed"] and rows[2].key_issues == [] and rows[2].agent_performance == "fair"
    assert rows[2].resolution_summary == "Customer's billing issue remains unresolved"
    assert rows[3].tags == ["billing_issue"] and rows[3].key_issues == ["bill"]


def test_confident_conversations_keep_their_record(spark, grouped_of):
    made = analysis.analyse(grouped_of({0: [(True, "my bill")]})).withColumn("needs_llm", F.lit(False))
    parsed = model_exchange.parse_analysis_replies(replies(spark, '{"tags": ["t"]}'))
    assert model_exchange.merge_replies(made, parsed).first().tags == ["billing_issue"]


def test_recommendation_replies(spark):
    def without(name):
        return json.dumps({key: value for key, value in GOOD.items() if key != name})

    texts = [json.dumps(GOOD), "```json\n" + json.dumps(GOOD) + "\n```", *map(without, GOOD),
             json.dumps({**GOOD, "channel": "fax"}), json.dumps({**GOOD, "issue_status": "odd"}),
             json.dumps({**GOOD, "channel": None}), json.dumps({**GOOD, "send_time": None}), "no json", "[]"]
    rows = model_exchange.read_recommendation_replies(replies(spark, *texts)).orderBy("conversation_id").collect()
    assert [row.reject_reason for row in rows] == [
        None, None, "missing_channel", "missing_send_time", "missing_message", "missing_reasoning",
        "missing_issue_status", "bad_channel", None, "bad_channel", None, "malformed", "malformed",
    ]
    assert rows[8].issue_status == "pending_customer_reply" and rows[10].send_time is None


def test_decide_prefers_replies(spark):
    customers = spark.createDataFrame(
        [(n, str(n), "billing", "low", "neutral", "polite") for n in range(3)],
        "conversation_id BIGINT, customer_id STRING, nature_of_request STRING, urgency_level STRING, "
        "customer_sentiment STRING, customer_behavior STRING",
    )
    usable = model_exchange.usable_replies(
        model_exchange.read_recommendation_replies(replies(spark, json.dumps(GOOD), "broken"))
    )
    chosen = {row.conversation_id: row for row in recommend.decide(customers, "2024-02-01 10:00:00", usable).collect()}
    assert chosen[0].channel == "email_reply" and chosen[0].reasoning == "r"
    assert chosen[1].channel == chosen[2].channel == "twitter_dm_reply"
    only = recommend.decide(customers, "2024-02-01 10:00:00", usable, rules=False)
    assert [row.conversation_id for row in only.collect()] == [0]


def test_requests_hold_the_whole_text(spark, grouped_of):
    grouped = grouped_of({1: [(True, f"word{n}") for n in range(7)], 2: [(False, "only agent")]})
    made = analysis.analyse(grouped)
    prompts = model_exchange.analysis_requests(made, grouped, block_messages=3).collect()
    assert [row.conversation_id for row in prompts] == [1]
    assert all(f"word{n}" in prompts[0].prompt for n in range(7)) and "key_issues" in prompts[0].prompt
    none = spark.createDataFrame([], "cohort_id BIGINT, cohort_name STRING")
    members = spark.createDataFrame([], "conversation_id BIGINT, cohort_id BIGINT")
    known = context.with_history(context.customer_context(made, grouped, none, members), grouped)
    asked = {row.conversation_id: row.prompt for row in model_exchange.recommendation_requests(known).collect()}
    assert "Customer: c1" in asked[1] and "\n---\n" in asked[1] and "Customer: none" in asked[2]


def test_replies_are_read_once(spark):
    """Leaving out replies by their reason does not read them again."""
    replies = spark.createDataFrame([(1, "{}"), (2, "x")], "conversation_id BIGINT, response_text STRING")
    read = model_exchange.read_recommendation_replies(replies)
    usable = read.where("reject_reason IS NULL")

    def parses(frame):
        return frame._jdf.queryExecution().optimizedPlan().toString().count("from_json(")

    assert parses(usable) == parses(read) > 0
