from pyspark.sql import functions as F

from threadloom.operators import context

ANALYSIS = "conversation_id BIGINT, is_resolved BOOLEAN, tags ARRAY<STRING>, nature_of_request STRING, " \
    "customer_sentiment STRING, urgency_level STRING, conversation_type STRING, customer_behavior STRING"


def setting(spark, grouped_of):
    grouped = grouped_of(
        {
            1: [(False, "hello"), (True, "my bill"), (True, "please")],
            2: [(True, "one"), (False, "two")],
            3: [(False, "a"), (False, "b")],
            4: [(True, "done"), (False, "bye")],
        }
    )
    rows = [(n, n == 4, ["t"], "billing", "neutral", "low", "follow_up", "polite") for n in (1, 2, 3, 4)]
    analysis = spark.createDataFrame(rows, ANALYSIS)
    cohorts = spark.createDataFrame([(1, "First"), (2, "Second")], "cohort_id BIGINT, cohort_name STRING")
    members = spark.createDataFrame([(1, 2), (1, 1), (2, 1), (4, 1)], "conversation_id BIGINT, cohort_id BIGINT")
    return analysis, grouped, cohorts, members


def test_context(spark, grouped_of):
    analysis, grouped, cohorts, members = setting(spark, grouped_of)
    made = context.customer_context(analysis, grouped, cohorts, members)
    rows = {row.conversation_id: row for row in context.with_history(made, grouped).collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[1].customer_id == "c1" and rows[1].latest_message == "please" and rows[1].total_messages == 3
    assert rows[1].customer_cohorts == "First; Second" and rows[3].customer_cohorts is None
    assert rows[3].customer_id is None and rows[3].cohort_count == 0
    assert rows[2].chat_history == "2024-01-01 09:00:00 | c2: one ### 2024-01-01 09:01:00 | agent: two"


def test_fanout(spark, grouped_of):
    analysis, grouped, cohorts, members = setting(spark, grouped_of)
    made = context.customer_context(analysis, grouped, cohorts, members)
    rows = {row.conversation_id: row for row in context.with_history(made, grouped, fanout=True).collect()}
    lines = rows[1].chat_history.split(" ### ")
    assert len(lines) == 6 and lines[0] == lines[1] and rows[1].customer_cohorts.count("First") == 3
    assert len(rows[2].chat_history.split(" ### ")) == 2 and rows[2].customer_cohorts == "First; First"
    assert len(rows[3].chat_history.split(" ### ")) == 2 and rows[3].customer_cohorts is None
    assert rows[1].total_messages == 3


def test_history_from_blocks_is_whole(spark, grouped_of):
    analysis, grouped, cohorts, members = setting(spark, grouped_of)
    made = context.customer_context(analysis, grouped, cohorts, members)
    for fanout in (False, True):
        whole = context.with_history(made, grouped, fanout=fanout).orderBy("conversation_id").collect()
        blocks = context.with_history(made, grouped, fanout=fanout, block_messages=2).orderBy("conversation_id").collect()
        assert blocks == whole


def test_messages_are_shuffled_once(spark, grouped_of):
    analysis, grouped, cohorts, members = setting(spark, grouped_of)
    made = context.customer_context(analysis, grouped, cohorts, members).checkpoint()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = context.with_history(made, grouped.checkpoint())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with_text = [line for line in plan.split("\n") if "Exchange" in line]
    assert len(with_text) <= 3


def test_analysed_messages(spark, grouped_of):
    analysis, grouped, _, _ = setting(spark, grouped_of)
    for hot_rows in (1_000_000, 2):
        joined = context.analysed_messages(analysis.where("conversation_id != 3"), grouped, hot_rows)
        assert joined.count() == 7 and joined.where(F.col("is_resolved")).count() == 2
