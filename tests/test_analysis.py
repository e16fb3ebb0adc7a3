import json
import random
import re

import pytest
from pyspark.sql import functions as F

from threadloom.functions import rules, sentiment
from threadloom.operators import analysis, transcripts
from threadloom.operators.threads import BLOCK_MESSAGES
from threadloom.schemas import RECORD_COLUMNS


def assessed(grouped):
    return {row.conversation_id: row for row in analysis.analyse(grouped).collect()}


def one(grouped_of, *turns):
    return assessed(grouped_of({1: list(turns)}))[1]


def customer(body):
    return (True, body)


def agent(body):
    return (False, body)


def test_resolution(grouped_of):
    rows = assessed(
        grouped_of(
            {
                1: [customer("it is fixed but i am frustrated")],  # one against one
                2: [customer("great perfect awesome excellent solved fixed great great perfect great "
                             "awesome awesome great solved great fixed great great awesome great")],
                3: [customer("angry frustrated angry frustrated angry angry angry angry")],
                4: [customer("hello there")],
                5: [customer("the problem"), agent("is gone")],  # a gap across messages
                6: [agent("gone"), customer("the problem")],
            }
        )
    )
    assert not rows[1].is_resolved and rows[1].resolution_confidence == pytest.approx(1 / 3)
    assert rows[2].is_resolved and rows[2].resolution_confidence == 0.95
    assert not rows[3].is_resolved and rows[3].resolution_confidence == 0.85
    assert not rows[4].is_resolved and rows[4].resolution_confidence == 0
    assert rows[5].is_resolved and rows[5].resolved_score == 0.8
    assert not rows[6].is_resolved and rows[6].resolved_score == 0


def test_urgency(grouped_of):
    cases = {
        "urgent and important": "critical",
        "important, whenever": "high",
        "whenever you like, just curious": "low",
        "whenever possible": "medium",
        "hello": "medium",
    }
    rows = assessed(grouped_of({n: [customer(body)] for n, body in enumerate(cases)}))
    assert [rows[n].urgency_level for n in range(len(cases))] == list(cases.values())


def test_agent_words_do_not_make_it_urgent(grouped_of):
    assert one(grouped_of, customer("hello"), agent("urgent")).urgency_level == "medium"


def test_labels(grouped_of):
    natures = {"bill": "billing", "bug": "technical", "login": "account", "tutorial": "product_info",
               "terrible": "complaint", "login bug": "technical", "hello": "billing"}
    behaviours = {"kindly": "polite", "hours ago": "impatient", "json": "technical", "i am confused": "confused",
                  "outraged": "angry", "certainly": "cooperative", "kindly asap": "polite", "hello": "polite"}
    bodies = [*natures, *behaviours]
    rows = assessed(grouped_of({n: [customer(body)] for n, body in enumerate(bodies)}))
    assert [rows[n].nature_of_request for n in range(len(natures))] == list(natures.values())
    offset = len(natures)
    assert [rows[offset + n].customer_behavior for n in range(len(behaviours))] == list(behaviours.values())
    assert rows[len(natures) - 1].nature_confidence == 0 and rows[0].nature_confidence == 0.5


def test_tags_keep_order_and_stop_at_five(grouped_of):
    row = one(grouped_of, customer("urgent: terrible bill, escalate, first time, again, thanks, worst"))
    assert row.tags == [
        "complaint_issue", "frustrated_customer", "critical_urgency", "escalation", "first_time_customer",
    ]
    assert one(grouped_of, customer("news against")).tags == ["billing_issue", "first_time_customer", "repeat_customer"]


def test_type_issues_agent(grouped_of):
    rows = assessed(
        grouped_of(
            {
                1: [customer("manager"), agent("x")],
                2: [customer("manager"), agent("x"), agent("y")],
                3: [customer("x")] * 7,
                4: [customer("x")] * 6,
                5: [customer("down slow error problem"), agent("login helped")],
                6: [customer("awful, thank you")],
                7: [customer("awful and terrible, thank you")],
                8: [customer("a | b"), agent("c")],
            }
        )
    )
    assert [rows[n].conversation_type for n in (1, 2, 3, 4)] == [
        "simple_inquiry", "escalation", "complex_issue", "follow_up",
    ]
    assert rows[5].key_issues == ["error", "problem", "slow"] and rows[5].agent_performance == "good"
    assert rows[6].agent_performance == "fair" and rows[7].agent_performance == "poor"
    assert rows[8].piece_count == 3 and rows[8].conversation_type == "follow_up"


def test_fallback_record(grouped_of):
    row = one(grouped_of, agent("thanks, resolved, urgent"))
    assert [row[name] for name in RECORD_COLUMNS] == [
        False, 0.5, ["analysis_failed"], "general", "neutral", "medium", "simple_inquiry", "neutral",
        "Unable to analyze conversation", ["unknown"], "fair",
    ]
    assert not row.needs_llm


def test_customer_mark_inside_an_agent_message(grouped_of):
    row = one(grouped_of, agent("they wrote | CUSTOMER: 7: it is urgent"))
    assert row.customer_messages == 1 and row.urgency_level == "critical"


VOCABULARY = (
    "still not working problem issue same need help that works all good sorted out everything fine thanks thank you "
    "fixed solved resolved closed when possible get back right now system down broken can't access losing money "
    "no rush how to what is mean don't understand sure could you would hours ago long waiting makes sense will try "
    "happy of course bill error api code login password feature explain worst angry escalate manager first again"
).split() + ["a|b", "|", "a | CUSTOMER: 5: urgent", "x:y", "İstanbul", "ß"]


def expected_scores(transcript):
    """The scores by regular expressions over the whole transcript."""
    lowered = transcript.lower()
    heard = [piece.split(":", 2) for piece in transcript.split(" | ") if "CUSTOMER:" in piece]
    spoken = " ".join(parts[2].strip() for parts in heard if len(parts) == 3).lower()
    scores = {}
    for (scope, family), patterns in rules.FAMILIES.items():
        body = lowered if scope == "transcript" else spoken
        scores[family] = sum(len(re.findall(pattern, body)) for pattern in patterns)
    scores["pieces"] = len(transcript.split(" | "))
    return scores


def test_features_equal_whole_transcript_counts(spark, grouped_of):
    draw = random.Random(3)
    conversations = {
        n: [
            (draw.random() < 0.6, " ".join(draw.choices(VOCABULARY, k=draw.randint(1, 9))))
            for _ in range(draw.randint(1, 7))
        ]
        for n in range(250)
    }
    grouped = grouped_of(conversations)
    features = analysis.conversation_features(transcripts.lines(grouped))
    shown = features.select(
        "conversation_id", "piece_count", *[rules.family_hits(family).alias(family) for _, family in rules.FAMILIES]
    )
    texts = {row.conversation_id: row.full_conversation for row in transcripts.transcripts(grouped).collect()}
    for row in shown.collect():
        wanted = expected_scores(texts[row.conversation_id])
        got = {family: row[family] for _, family in rules.FAMILIES} | {"pieces": row.piece_count}
        assert got == wanted, texts[row.conversation_id]


def test_parts_and_transcript_input(grouped_of):
    grouped = grouped_of({1: [(n % 2 == 0, f"message {n} bug") for n in range(9)], 2: [customer("hi"), agent("ho")]})
    parts = transcripts.transcript_parts(grouped, 4).orderBy("conversation_id", "part").collect()
    assert [(row.conversation_id, row.part, row.message_count) for row in parts] == [
        (1, 0, 4), (1, 1, 4), (1, 2, 1), (2, 0, 2),
    ]
    whole = {row.conversation_id: row.full_conversation for row in transcripts.transcripts(grouped).collect()}
    assert " | ".join(row.full_conversation for row in parts[:3]) == whole[1]
    direct = assessed(grouped)
    read = {
        row.conversation_id: row
        for row in analysis.analyse_transcripts(transcripts.transcripts(grouped)).collect()
    }
    assert read == direct
    blocks = {row.conversation_id: row.full_conversation for row in transcripts.transcripts(grouped, 2).collect()}
    assert blocks == whole


def test_patterns_span_parts(grouped_of):
    texts = ["my issue here", "a", "b", "c", "it is closed", "now"]
    grouped = grouped_of({1: [(n % 2 == 0, body) for n, body in enumerate(texts)]})
    direct = assessed(grouped)
    for size in (1, 2, 4):
        parts = analysis.analyse_transcripts(transcripts.transcript_parts(grouped, size))
        assert {row.conversation_id: row for row in parts.collect()} == direct


def test_one_row_at_any_length(spark):
    rows = spark.range(5001).select(
        F.lit(1).cast("bigint").alias("conversation_id"), F.lit("c").alias("author_id"), F.lit(True).alias("is_customer"),
        F.concat(F.lit("m"), "id").alias("message_text"), F.timestamp_seconds("id").alias("created_at"),
        F.col("id").cast("int").alias("sequence_number"),
    )
    row = transcripts.transcripts(rows).collect()
    assert len(row) == 1 and row[0].message_count == 5001
    assert row[0].full_conversation == " | ".join(f"CUSTOMER: c: m{n}" for n in range(5001))


def test_terms_combine_before_the_shuffle(grouped_of):
    frame = analysis.analyse(grouped_of({1: [customer("x")]}))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "partial_sum" in plan and "Window" not in plan


def test_self_overlapping_and_touching_literals(grouped_of):
    cases = {1: "excusexcuse", 2: "excusexcusexcuse", 3: "makesense", 4: "makesense and sense", 5: "sense makes",
             6: "makes no sense", 7: "settingsettings settings"}
    features = analysis.conversation_features(
        transcripts.lines(grouped_of({n: [customer(body)] for n, body in cases.items()}))
    )
    families = ["behaviour_polite", "behaviour_cooperative", "nature_account"]
    got = {
        row.conversation_id: {name: row[name] for name in families}
        for row in features.select("conversation_id", *[rules.family_hits(f).alias(f) for f in families]).collect()
    }
    for number, body in cases.items():
        wanted = expected_scores(f"CUSTOMER: c{number}: {body}")
        assert got[number] == {name: wanted[name] for name in families}, body


@pytest.mark.parametrize(
    "score, mood, sureness",
    [(0.05, "positive", 0.05), (0.0499, "neutral", 0.9501), (-0.05, "negative", 0.05), (-0.4999, "negative", 0.4999),
     (-0.5, "frustrated", 0.5), (0.0, "neutral", 1.0)],
)
def test_buckets(spark, score, mood, sureness):
    row = spark.range(1).select(
        sentiment.bucket(F.lit(score)).alias("mood"), sentiment.bucket_confidence(F.lit(score)).alias("sureness")
    ).first()
    assert row.mood == mood and row.sureness == pytest.approx(sureness)


def test_valence(spark):
    cases = {
        "good": 1.9, "not good": 1.9 * -0.74, "very good": 2.193, "really, very good": 1.9 + 0.293 + 0.293 * 0.95,
        "slightly bad": -2.5 + 0.293, "not a very good": (1.9 + 0.293) * -0.74, "not one two three good": 1.9,
        "": 0.0, "nothing here": 0.0, None: 0.0,
        # capitals count only among words that are not, and for boosters too
        "that is GOOD": 1.9 + 0.733, "THAT IS GOOD": 1.9, "that is BAD": -2.5 - 0.733, "a VERY good one": 1.9 + 0.293 + 0.733,
        "a Good one": 1.9, "GOOD :)": 1.9 + 0.733 + 2.0,
        # marks
        "good!": 1.9 + 0.292, "bad!!": -2.5 - 0.584, "good!!!!!!": 1.9 + 1.168, "table!!!": 0.0,
        "good?": 1.9, "good??": 1.9 + 0.36, "bad???": -2.5 - 0.54, "bad?????": -2.5 - 0.96, "good?!?": 1.9 + 0.292 + 0.36,
        # a turn
        "good but bad": 1.9 * 0.5 - 2.5 * 1.5, "good but good but good": 1.9 * 0.5 + 2 * 1.9 * 1.5, "but": 0.0, "button good": 1.9,
        # idioms, emoticons, emoji
        "Yeah right, good": -2.0 + 1.9, "yeah, right": 0.0, "yeah rightly": 0.0, "not to die for": 3.0 * -0.74,
        "ok:(": 1.2 - 1.9, "\U0001f44d\U0001f44d": 3.8, "see http://x": 0.0,
    }
    rows = spark.createDataFrame([(body, value) for body, value in cases.items()], "body STRING, value DOUBLE")
    scored = sentiment.with_valence(rows, "body", "got")
    assert scored.columns == ["body", "value", "got"]
    for row in scored.collect():
        assert row.got == pytest.approx(row.value), row.body
    own = sentiment.with_valence(rows.where("body = 'not good'"), "body", valences={"good": -1.0}).first()
    assert own.valence == pytest.approx(0.74)


def test_storage_forms(spark, grouped_of):
    made = analysis.analyse(grouped_of({1: [customer("bill")], 2: [customer("thanks")]}))
    stored = analysis.records(made)
    payload = json.loads(stored.where("conversation_id = 1").first().payload)
    assert list(payload) == RECORD_COLUMNS and payload["tags"] == ["billing_issue"]
    partial = made.where("conversation_id = 1").withColumns(
        {"tags": F.lit(None).cast("array<string>"), "is_resolved": F.lit(None).cast("boolean")}
    )
    merged = analysis.upsert(stored, analysis.with_defaults(partial))
    rows = {row.conversation_id: row for row in merged.collect()}
    assert set(rows) == {1, 2} and rows[1].tags == [] and rows[1].is_resolved is False and rows[2].is_resolved


def test_tag_tables(spark):
    frame = spark.createDataFrame([(1, ["a", "b"]), (2, ["b"]), (3, [])], "conversation_id BIGINT, tags ARRAY<STRING>")
    assert {row.tag: row.uses for row in analysis.tag_counts(frame).collect()} == {"a": 1, "b": 2}
    assert sorted(row.tag for row in analysis.unique_tags(frame).collect()) == ["a", "b"]
    texts = spark.createDataFrame([('["x"]',), ("[broken",), (None,), ('["y", "x"]',)], "tags STRING")
    assert sorted(row.tag for row in analysis.tags_from_json(texts).collect()) == ["x", "y"]


def test_terms_add_up_in_columns_of_fixed_width(grouped_of):
    features = analysis.conversation_features(transcripts.lines(grouped_of({1: [customer("urgent"), agent("thanks")]})))
    kinds = [kind for name, kind in features.dtypes if name != "conversation_id"]
    assert set(kinds) <= {"bigint", "double"}
    plan = features._jdf.queryExecution().sparkPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_terms_add_up_by_conversation_before_the_shuffle(grouped_of):
    long = [customer("the problem"), *[agent("hello")] * BLOCK_MESSAGES, customer("is gone, thanks")]
    grouped = grouped_of({1: long, 2: [customer("gone"), agent("problem")]})
    plan = analysis.conversation_features(transcripts.lines(grouped))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and "Aggregate [conversation_id" in plan
    rows = assessed(grouped)  # a gap between two blocks
    assert rows[1].resolved_score == 1.8 and rows[1].message_count == BLOCK_MESSAGES + 2
    assert rows[2].resolved_score == 0 and rows[2].message_count == 2
