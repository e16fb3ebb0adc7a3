import csv
import glob

import pytest
from pyspark.sql import functions as F

from threadloom.operators import analysis as analysing
from threadloom.plans import jobs, stages
from threadloom.schemas import RECOMMENDATION_COLUMNS
from threadloom.sources import files

FEED = [
    ("tweet_id", "author_id", "inbound", "created_at", "text", "response_tweet_id", "in_response_to_tweet_id"),
    ("1", "cust", "True", "Tue Oct 31 22:10:47 +0000 2017", 'My "bill", is wrong\nvery wrong', "2", ""),
    ("2", "Acme", "False", "Tue Oct 31 22:11:47 +0000 2017", "@cust please | send ### it", "3", "1.0"),
    ("3", "cust", "True", "Tue Oct 31 22:12:47 +0000 2017", "still not working, urgent", "", "2.0"),
    ("4", "other", "True", "Tue Oct 31 22:13:47 +0000 2017", "alone", "", ""),
    ("5", "fan", "True", "Tue Oct 31 22:14:47 +0000 2017", "thanks, all set", "", ""),
    ("6", "Acme", "False", "Tue Oct 31 22:15:47 +0000 2017", "great", "", "5"),
    ("7", "x", "True", "no time", "lost", "", ""),
]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    feed = folder / "feed.csv"
    with open(feed, "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows(FEED)
    tables, export = str(folder / "tables"), str(folder / "export")
    summaries = jobs.run_all(spark, str(feed), tables, export, "2024-02-01 10:00:00")
    return tables, export, [summary.collect() for summary in summaries]


def test_summaries(run):
    _, _, (ingest, behaviour, channels) = run
    assert tuple(ingest[0]) == (6, 2)
    assert (behaviour[0].total_analyzed, behaviour[0].resolved_count, behaviour[0].open_count) == (2, 1, 1)
    assert [tuple(row) for row in channels] == [("scheduling_phone_call", 1)]


def test_tables(spark, run):
    tables, _, _ = run
    grouped = files.read_table(spark, tables, files.GROUPED).orderBy("conversation_id", "sequence_number").collect()
    assert [(row.conversation_id, row.tweet_id) for row in grouped] == [(1, "1"), (1, "2"), (1, "3"), (2, "5"), (2, "6")]
    assert grouped[0].message_text == 'My "bill", is wrong very wrong' and grouped[1].message_text.startswith("@USER")
    assert [row.reject_reason for row in files.read_table(spark, tables, files.REJECTS).collect()] == ["bad_created_at"]
    stored = files.read_table(spark, tables, files.ANALYSIS).where("conversation_id = 1").first()
    assert stored.analysis_method == "hybrid" and not stored.is_resolved and stored.urgency_level == "critical"


def test_export(spark, run):
    _, export, _ = run
    text = "".join(open(path, encoding="utf-8").read() for path in glob.glob(f"{export}/part-*"))
    assert text.startswith(",".join(f'"{name}"' for name in RECOMMENDATION_COLUMNS))
    row = files.read_recommendations_csv(spark, export).collect()
    assert len(row) == 1 and row[0].customer_id == "cust" and row[0].conversation_id == 1
    assert " ### " not in row[0].chat_history.replace("send ### it", "") and '"bill"' in row[0].chat_history
    assert row[0].chat_history.startswith("2017-10-31 22:10:47 | cust: My")


def test_upsert_and_clear(spark, run, tmp_path):
    tables, _, _ = run
    rows = files.read_table(spark, tables, files.ANALYSIS)
    folder = str(tmp_path)
    files.write_table(rows, folder, files.ANALYSIS)
    changed = rows.where("conversation_id = 2").replace({"positive": "neutral"}, subset=["customer_sentiment"])
    merged = files.upsert_analysis(changed, folder)
    assert merged.count() == 2
    assert merged.where("conversation_id = 2").first().customer_sentiment == "neutral"
    files.clear_analysis(
        spark, folder, "conversation_id BIGINT", "cohort_id BIGINT", "conversation_id BIGINT, cohort_id BIGINT"
    )
    assert files.read_table(spark, folder, files.ANALYSIS).count() == 0


def test_nothing_to_export(spark, run, tmp_path):
    tables, export, _ = run
    none = files.read_recommendations_csv(spark, export).limit(0)
    assert not files.write_recommendations_csv(none, str(tmp_path / "none")) and not (tmp_path / "none").exists()


def test_limit_and_classifier_choice(spark, run, tmp_path):
    tables, _, _ = run
    folder = str(tmp_path)
    files.write_table(files.read_table(spark, tables, files.GROUPED), folder, files.GROUPED)
    assert jobs.behaviour(spark, folder, classifier="rules", limit=1, id_order="text").first().total_analyzed == 1
    with pytest.raises(ValueError):
        stages.assess_conversations(files.read_table(spark, folder, files.GROUPED), classifier="guess")
    assert analysing.unresolved(files.read_table(spark, folder, files.ANALYSIS)).count() == 1


@pytest.mark.parametrize("rows, rejected", [(FEED[:1], 0), ([FEED[0], FEED[7]], 1), ([FEED[0], FEED[4]], 0)])
def test_feeds_without_conversations(spark, tmp_path, rows, rejected):
    feed, tables = tmp_path / "feed.csv", str(tmp_path / "tables")
    with open(feed, "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows(rows)
    summaries = jobs.run_all(
        spark, str(feed), tables, str(tmp_path / "export"), "2024-02-01 10:00:00", classifier="rules"
    )
    assert [summary.collect() for summary in summaries][0][0].conversations_created == 0
    assert files.read_table(spark, tables, files.REJECTS).count() == rejected
    assert not (tmp_path / "export").exists()


def test_export_goes_through_its_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    texts = [F.lit("x").alias(name) for name in RECOMMENDATION_COLUMNS if name != "conversation_id"]
    numbers = spark.range(1000, numPartitions=8).mapInArrow(counted, "id BIGINT")
    rows = numbers.select(F.col("id").alias("conversation_id"), *texts)
    nothing = rows.groupBy(*RECOMMENDATION_COLUMNS).count().where("count > 1").drop("count")
    assert not files.write_recommendations_csv(nothing, str(tmp_path / "none")) and not list(tmp_path.iterdir())
    seen.value = 0
    assert files.write_recommendations_csv(rows.repartition(4), str(tmp_path / "out"))
    assert seen.value == 1000
    assert files.read_recommendations_csv(spark, str(tmp_path / "out")).count() == 1000
