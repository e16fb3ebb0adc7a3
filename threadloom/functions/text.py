"""Column expressions for ids, message text, timestamps and letter case.

The character classes are spelled out because ``\\w`` and ``\\s`` are ASCII-only in Java.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1c-\x1f\x85\p{Z}]"
NOT_SPACE = r"[^\t-\r\x1c-\x1f\x85\p{Z}]"
# Runs of white space, but for the usual single blank.
UNUSUAL_SPACE = rf"{SPACE}{{2,}}|[\t-\r\x1c-\x1f\x85\p{{Z}}&&[^ ]]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def clean_text(text: Column) -> Column:
    """Drop links, mask mentions, drop hashtags, fold whitespace, trim; null becomes empty."""
    masked = F.regexp_replace(
        F.regexp_replace(F.coalesce(text, F.lit("")), f"https?://{NOT_SPACE}+", ""),
        f"@{WORD}+",
        "@USER",
    )
    return F.trim(F.regexp_replace(F.regexp_replace(masked, f"#{WORD}+", ""), UNUSUAL_SPACE, " "))


def clean_id(value: Column) -> Column:
    """Integer text for numeric ids (``'119237.0'`` -> ``'119237'``), '' for missing, other text unchanged.

    Plain digits go through DECIMAL, not DOUBLE, so ids beyond 2^53 keep every digit. Ids that are digits already, the
    usual case, only lose what follows them.
    """
    usual = value.rlike(r"^[1-9]\d{0,36}(\.\d*)?\z")
    bare = strip(value)
    whole = F.regexp_extract(bare, r"^([+-]?\d+)(?:\.\d*)?$", 1)
    as_integer = F.when(whole != "", whole.try_cast("decimal(38,0)").cast("string"))
    as_fraction = F.when(bare.rlike(r"^[+-]?\.\d+$"), F.lit("0"))
    as_exponent = F.when(
        bare.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)[eE][+-]?\d+$"),
        bare.try_cast("double").try_cast("bigint").cast("string"),
    )
    return (
        F.when(value.isNull() | value.isin("", "nan"), F.lit(""))
        .when(usual, F.substring_index(value, ".", 1))
        .otherwise(F.coalesce(as_integer, as_fraction, as_exponent, value))
    )


def parse_time(value: Column) -> Column:
    """ISO text, or ``Tue Oct 31 22:10:47 +0000 2017``; null when neither fits."""
    text = value.cast("string")
    feed_style = F.when(
        text.rlike(r"^[A-Z][a-z]{2} [A-Z][a-z]{2} \d"),
        F.try_to_timestamp(F.substr(text, F.lit(5)), F.lit("MMM dd HH:mm:ss Z yyyy")),
    )
    return F.coalesce(F.try_to_timestamp(text), feed_style)


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def clock_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
