import json

import pytest

from threadloom.operators import cohorts

FIELDS = "conversation_id BIGINT, is_resolved BOOLEAN, tags ARRAY<STRING>, nature_of_request STRING, " \
    "customer_sentiment STRING, urgency_level STRING, conversation_type STRING, customer_behavior STRING"


@pytest.fixture(scope="module")
def analysis(spark):
    rows = [
        (1, False, ["billing_issue", "rare"], "billing", "frustrated", "high", "escalation", "impatient"),
        (2, True, ["billing_issue", "twice"], "technical", "positive", "medium", "follow_up", "technical"),
        (3, True, ["billing_issue", "billing_issue"], "general", "neutral", "low", "simple_inquiry", "polite"),
        (4, False, ["twice"], "product_info", "neutral", "low", "simple_inquiry", "confused"),
    ]
    return spark.createDataFrame(rows, FIELDS)


def test_members_and_ids(analysis):
    made, members = cohorts.build_cohorts(analysis)
    shown = {row.cohort_id: row for row in made.collect()}
    assert [shown[n].cohort_name for n in sorted(shown)] == [
        "Frustrated Billing Customers", "Technical Power Users", "Urgent Unresolved Issues", "Satisfied Customers",
        "Impatient Customers", "Complex Escalations", "Polite General Inquiries", "Tag: Billing Issue",
    ]
    by_cohort = {}
    for row in members.collect():
        by_cohort.setdefault(row.cohort_id, []).append(row.conversation_id)
    assert {n: sorted(found) for n, found in by_cohort.items()} == {
        1: [1], 2: [2], 3: [1], 4: [2], 5: [1], 6: [1], 7: [3], 8: [1, 2, 3],
    }
    assert shown[8].conversation_count == 3 and json.loads(shown[8].cohort_criteria) == {"tag": "billing_issue"}
    assert json.loads(shown[3].cohort_criteria) == {"urgency_level": ["high", "critical"], "is_resolved": False}


def test_only_ten_tags(spark):
    rows = [(n, False, [f"t{k:02d}" for k in range(12)], "x", "x", "x", "x", "x") for n in range(4)]
    frame = spark.createDataFrame(rows, FIELDS)
    made, _ = cohorts.build_cohorts(frame)
    assert sorted(row.cohort_name for row in made.collect()) == [f"Tag: T{k:02d}" for k in range(10)]


def test_frequent_tag_in_too_few_conversations(spark):
    rows = [(n, False, ["same", "same"], "x", "x", "x", "x", "x") for n in range(2)]
    made, members = cohorts.build_cohorts(spark.createDataFrame(rows, FIELDS))
    assert made.count() == 0 and members.count() == 0


def test_no_analysis_no_cohorts(spark):
    made, members = cohorts.build_cohorts(spark.createDataFrame([], FIELDS))
    assert made.count() == 0 and members.count() == 0


def test_report_keeps_empty_cohorts(spark, analysis):
    made, members = cohorts.build_cohorts(analysis)
    extra = spark.createDataFrame([(99, "Empty", "", "{}", 0)], made.schema)
    report = cohorts.cohort_report(made.unionByName(extra), members).collect()
    assert report[0].cohort_name == "Tag: Billing Issue" and report[0].sample_conversations == [1, 2, 3]
    empty = next(row for row in report if row.cohort_id == 99)
    assert empty.actual_count == 0 and empty.sample_conversations == []


def test_sample_ranking_is_limited_before_the_shuffle(spark):
    members = spark.range(5000).selectExpr("id AS conversation_id", "id % 2 AS cohort_id")
    analysis = spark.range(5000).selectExpr("id AS conversation_id", "'a' AS customer_sentiment", "'b' AS nature_of_request")
    sample = cohorts.cohort_samples(analysis, members)
    assert "WindowGroupLimit" in sample._jdf.queryExecution().executedPlan().toString()
    assert sorted(row.conversation_id for row in sample.collect()) == [0, 1, 2, 3, 4, 5]


def test_analysis_report(spark, analysis):
    made, _ = cohorts.build_cohorts(analysis)
    report = cohorts.analysis_report(analysis, made)
    assert report.columns == ["section", "name", "size"]
    found = {(row.section, row["name"]): row["size"] for row in report.collect()}
    assert {name: size for (section, name), size in found.items() if section == "status"} == {"resolved": 2, "open": 2}
    assert found[("tag", "billing_issue")] == sum(row.tags.count("billing_issue") for row in analysis.collect())
    assert found[("cohort", "Tag: Billing Issue")] == 3 and found[("cohort", "Technical Power Users")] == 1
    none = analysis.limit(0)
    empty = cohorts.analysis_report(none, cohorts.build_cohorts(none)[0]).collect()
    assert all(row.section == "cohort" and row["size"] == 0 for row in empty)
