import datetime as dt

import pytest
from pyspark.sql import functions as F

from threadloom.functions import text


def values(spark, expression, inputs):
    rows = spark.createDataFrame([(n, value) for n, value in enumerate(inputs)], "n INT, v STRING")
    return [row[0] for row in rows.orderBy("n").select(expression(F.col("v"))).collect()]


def test_ids(spark):
    cases = {
        None: "", "": "", "nan": "", "119237.0": "119237", "12": "12", "1,2": "1,2", "5f": "5f", "5d": "5d", " 7 ": "7",
        "-3.9": "-3", "+4": "4", "007": "7", ".5": "0", "1e3": "1000", "None": "None", "abc": "abc",
        "9007199254740993": "9007199254740993", "inf": "inf", " 8 ": "8",
    }
    assert values(spark, text.clean_id, list(cases)) == list(cases.values())


def test_clean_text(spark):
    cases = {
        None: "",
        "https://t.co/x": "",
        "see http://a.b/c?d=1#e now": "see now",
        "@Ünï_9 hello": "@USER hello",
        "@中文 hi": "@USER hi",
        "a@b.com": "a@USER.com",
        "it&#39;s": "it&;s",
        "a\u00a0 b\n\n c\u2003d\x1ce\u0085f": "a b c d e f",
        "#tag only": "only",
        "@USER stays": "@USER stays",
        "httpx://kept https://": "httpx://kept https://",
        "   ": "",
    }
    assert values(spark, text.clean_text, list(cases)) == list(cases.values())


def test_times(spark):
    cases = {
        "2017-10-31 22:10:47": dt.datetime(2017, 10, 31, 22, 10, 47),
        "2017-10-31T22:10:47+02:00": dt.datetime(2017, 10, 31, 20, 10, 47),
        "Tue Oct 31 22:10:47 +0000 2017": dt.datetime(2017, 10, 31, 22, 10, 47),
        "junk": None,
        None: None,
    }
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    shown = values(spark, lambda c: text.clock_text(text.parse_time(c)), list(cases))
    assert shown == [None if t is None else t.strftime("%Y-%m-%d %H:%M:%S") for t in cases.values()]


@pytest.mark.parametrize("given", ["first time customer", "o'neil is 3rd-best", "API errors", "x", "état 2b or not2b"])
def test_title_case(spark, given):
    assert values(spark, text.title_case, [given]) == [given.title()]


def test_usual_ids_only_lose_what_follows_them(spark):
    cases = {
        "7": "7", "119237.0": "119237", "12.": "12", "12.50": "12", "9" * 37: "9" * 37, "9" * 38: "9" * 38, "9" * 39: "9" * 39,
        "007.0": "7", "0": "0", "12\n": "12", "12.0\n": "12", " 12.0 ": "12", "+5": "5", "1.2.3": "1.2.3", "1e2": "100", "12a": "12a",
    }
    rows = spark.createDataFrame([(value,) for value in cases], "value STRING")
    found = rows.select("value", text.clean_id(F.col("value")).alias("id"))
    assert {row.value: row.id for row in found.collect()} == cases
    assert "substring_index" in found._jdf.queryExecution().optimizedPlan().toString()
