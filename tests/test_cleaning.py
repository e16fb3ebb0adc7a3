import datetime as dt

import pytest
from pyspark.sql import functions as F

from threadloom.operators import cleaning

COLUMNS = "tweet_id STRING, author_id STRING, inbound STRING, created_at STRING, text STRING, " \
    "response_tweet_id STRING, in_response_to_tweet_id STRING"


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(
        [
            ("1.0", "a", "True", "2024-01-01 10:00:00", "hello  @bob", "2,3", None),
            ("2", None, "False", "2024-01-01 10:01:00", "hi", "", "1.0"),
            ("2", "b", "False", "2024-01-01 10:05:00", "later copy", "", "1"),
            ("3", "a", None, "2024-01-01 10:02:00", "https://t.co/x", "", "2.0"),
            ("4", "a", "False", "not a time", "text", "", ""),
            (None, "a", "True", "2024-01-01 10:02:00", "text", "", ""),
            ("5", "a", "True", "Mon Jan 01 10:03:00 +0000 2024", "child of dropped", "", "3"),
        ],
        COLUMNS,
    )


def test_clean_messages(raw):
    rows = {row["tweet_id"]: row for row in cleaning.clean_messages(raw).collect()}
    assert set(rows) == {"1", "2", "5"}
    assert rows["1"]["text"] == "hello @USER" and rows["1"]["inbound"] is True
    assert rows["1"]["response_tweet_id"] == "2,3" and rows["1"]["in_response_to_tweet_id"] == ""
    assert rows["2"]["text"] == "hi" and rows["2"]["author_id"] == "unknown" and rows["2"]["inbound"] is False
    assert rows["2"]["in_response_to_tweet_id"] == "1"
    assert rows["5"]["created_at"] == dt.datetime(2024, 1, 1, 10, 3)


def test_rejects(raw):
    assert sorted(row["reject_reason"] for row in cleaning.rejects(raw).collect()) == [
        "bad_created_at",
        "missing_message_id",
    ]


def test_first_copy_decides_even_when_empty(spark):
    raw = spark.createDataFrame(
        [
            ("1", "a", "True", "2024-01-01 10:00:00", "https://t.co/x", "", ""),
            ("1", "a", "True", "2024-01-01 11:00:00", "words", "", ""),
        ],
        COLUMNS,
    )
    assert cleaning.clean_messages(raw).count() == 0


def test_report_and_order(raw):
    cleaned = cleaning.clean_messages(raw)
    report = cleaning.cleaning_report(raw, cleaned).first()
    assert (report.raw_rows, report.clean_rows, report.removed_rows) == (7, 3, 4)
    assert (report.messages_with_parent, report.parents_referenced) == (2, 2)
    assert [row.tweet_id for row in cleaning.in_time_order(cleaned).collect()] == ["1", "2", "5"]
    assert [tuple(row) for row in cleaning.link_sample(cleaned).collect()] == [("2", "1"), ("5", "3")]


def test_cleaning_twice_changes_nothing(raw):
    once = cleaning.clean_messages(raw)
    twice = cleaning.clean_messages(once)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_duplicates_are_combined_before_the_shuffle(spark, raw):
    copies = raw.where("tweet_id = '2'").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("copy")
    plan = cleaning.drop_duplicates(cleaning.normalise_types(copies))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    assert cleaning.drop_duplicates(cleaning.normalise_types(copies)).agg(F.max("text")).first()[0] == "hi"


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rows_of_their_own_are_not_combined(spark, raw, grouped_of):
    """Sorted aggregates touch repeated keys only, and unresolved conversations are chosen below the aggregate."""
    from threadloom.operators import analysis, context

    plan = _plan(cleaning.clean_messages(raw.checkpoint()))
    assert plan.count("SortAggregate") <= 2 and "LeftAnti" in plan and "LeftSemi" in plan
    assert "SortAggregate" not in _plan(context.conversation_edges(grouped_of({1: [(True, "x"), (False, "y")]})))
    stored = spark.createDataFrame([(1, "a"), (2, "b")], "conversation_id BIGINT, note STRING")
    fresh = spark.createDataFrame([(2, "c"), (3, "d"), (3, "e")], "conversation_id BIGINT, note STRING")
    merged = analysis.upsert(stored, fresh)
    assert sorted(tuple(row) for row in merged.collect()) == [(1, "a"), (2, "c"), (3, "e")]


def test_rows_are_not_shuffled_for_a_few_repeated_keys(raw, monkeypatch):
    from threadloom.operators import scale

    few = cleaning.clean_messages(raw)
    assert "BroadcastHashJoin" in _plan(few) and "SortMergeJoin" not in _plan(few)
    alone = cleaning.clean_messages(raw.where("tweet_id NOT IN ('2', '2.0')"))
    assert "Join" not in _plan(alone) and "Exchange" not in _plan(alone)
    monkeypatch.setattr(scale, "MAX_HOT_KEYS", 0)
    many = cleaning.clean_messages(raw)
    assert "BroadcastHashJoin" not in _plan(many)
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))


def test_texts_are_cleaned_once(raw):
    """Dropping empty texts does not clean them a second time."""
    plan = cleaning.drop_empty(cleaning.clean_texts(raw))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("https?") == 1


def test_white_space_of_every_kind_is_folded(spark):
    bodies = {"a b": "a b", "a\tb": "a b", "a  b": "a b", "　a b \n ": "a b", "a  b\x1fc": "a b c", "a\u0085b": "a b",
              "\ta": "a", "a ": "a", " #tag \t": ""}
    frame = spark.createDataFrame([(body,) for body in bodies], "text STRING")
    assert [row.text for row in cleaning.clean_texts(frame).collect()] == list(bodies.values())
