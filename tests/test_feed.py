"""CSV feeds that are cut into records by many tasks, against the reader that takes a file in one task."""

import csv
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threadloom.operators import cleaning
from threadloom.schemas import POSITION, RAW_CSV
from threadloom.sources import feed

HEADER = "tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id"
PIECES = ["a", 'b"b', '"q"', "\n", "\n\n", ",", " ", '"', '""', "x y", "é€", "\r\n"]
STRAY = ['he is 5" tall', "plain", '5"', 'say "hi" now', '"a" b', '"a"b"c']


@pytest.fixture
def small_ranges(spark):
    kept = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for name, value in kept.items():
        spark.conf.set(name, value)


def by_one_task(spark, path):
    return spark.read.schema(RAW_CSV).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def write_feed(path, seed, rows=60, stray=0.1):
    pick = random.Random(seed)
    lines = [HEADER]
    for k in range(rows):
        text = '"' + "".join(pick.choice(PIECES) for _ in range(pick.randint(0, 6))).replace('"', '""') + '"'
        if pick.random() < stray:
            text = pick.choice(STRAY)
        lines.append(pick.choice([f"{k},u,True,2017,{text},,{k}"] * 20 + [f"{k},u,True,2017,{text},,{k},extra", f"{k},short"]))
        if pick.random() < 0.05:
            lines.append("")
    with open(path, "w", newline="", encoding="utf-8") as out:
        out.write(pick.choice(["\n", "\r\n"]).join(lines) + pick.choice(["", "\n"]))


@pytest.mark.parametrize("seed, stray", [(1, 0.0), (2, 0.0), (3, 0.15), (4, 0.15), (5, 0.4)])
def test_rows_are_those_of_the_one_task_reader(spark, tmp_path, small_ranges, seed, stray):
    for k in range(2):
        write_feed(tmp_path / f"feed{k}.csv", 10 * seed + k, stray=stray)
    found = feed.read_csv(spark, str(tmp_path), multiline=True)
    assert Counter(found.collect()) == Counter(by_one_task(spark, str(tmp_path)).collect())
    assert Counter(feed.read_csv(spark, str(tmp_path)).collect()) == Counter(found.collect())


def test_one_quoted_line_break_leaves_the_file_to_many_tasks(spark, tmp_path, small_ranges):
    path = str(tmp_path / "feed.csv")
    rows = [(str(k), "u", "True", "2017", f"text {k}" if k != 40 else "two\nlines", "", "") for k in range(120)]
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator="\n").writerows([HEADER.split(","), *rows])
    lines = feed._lines(spark, path)
    known = feed.ranges(lines)
    assert known.count() > 10 and known.where("breaks").count() <= 2
    tasks = lines.select(F.spark_partition_id().alias("task")).distinct().count()
    found = feed.read_csv(spark, path, position=True)
    assert tasks > 5 and found.select(f"{POSITION}.at").distinct().count() > 10
    assert sorted(row.text for row in found.collect()) == sorted(row[4] for row in rows)


def test_a_text_over_many_ranges(spark, tmp_path, small_ranges):
    path = str(tmp_path / "feed.csv")
    long = "\n".join(f'line {k}, "quoted"' for k in range(400))
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator="\n").writerows([HEADER.split(","), ("1", "u", "", "", "first", "", ""), ("2", "u", "", "", long, "", ""), ("3", "", "", "", "a\nb", "", "")])
    assert sorted((row.tweet_id, row.text) for row in feed.read_csv(spark, path).collect()) == [("1", "first"), ("2", long), ("3", "a\nb")]


def test_feeds_without_records(spark, tmp_path):
    (tmp_path / "header.csv").write_text(HEADER + "\n")
    (tmp_path / "nothing.csv").write_text("")
    assert feed.read_csv(spark, str(tmp_path), multiline=True).count() == 0
    assert feed.read_csv(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("line, outside, inside", [
    ("plain", False, True), ('a,"b",c', False, False), ('a,"b', True, False), ('b",c', False, False), ('b"",c', False, True),
    ('5" tall,"x', True, True), ('""', False, True), ('"', True, False), ('"""', True, False), ('x,"""', True, False), ("", False, True),
])
def test_what_a_line_does_to_a_reader(spark, line, outside, inside):
    row = spark.createDataFrame([(line,)], "value STRING").select(
        feed.leaves_inside(F.col("value"), False).alias("outside"), feed.leaves_inside(F.col("value"), True).alias("inside")
    ).first()
    assert (row.outside, row.inside) == (outside, inside)


@pytest.mark.parametrize("breaks", [False, True])
def test_the_first_row_of_the_feed_can_be_kept(spark, tmp_path, small_ranges, breaks):
    pick, expected = random.Random(3), {}
    for name in ("a.csv", "b.csv"):
        with open(tmp_path / name, "w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out, lineterminator="\n")
            writer.writerow(HEADER.split(","))
            for k in range(80):
                key, text = str(pick.randint(1, 30)), f"{name} {k}" + ("\nmore" if breaks and k % 9 == 0 else "")
                time = f"Tue Oct 31 {pick.randint(10, 23)}:11:47 +0000 2017"
                writer.writerow((key, "u", "True", time, text, "", ""))
                expected.setdefault(key, text)
    raw = feed.read_csv(spark, str(tmp_path), position=True)
    typed = cleaning.usable(cleaning.normalise_types(raw, POSITION))
    assert {row.tweet_id: row.text for row in cleaning.drop_duplicates(typed, keep="first").collect()} == expected
    with pytest.raises(ValueError):
        cleaning.drop_duplicates(typed, keep="last")
