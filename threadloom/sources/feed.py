"""Message feeds in CSV, read by many tasks per file even where quoted texts go over line ends.

A task that begins in the middle of a file cannot know whether it begins inside a quoted text. Each line is therefore
a function of that: where it leaves a reader that comes in outside, and one that comes in inside, of a quoted text. The
functions of a byte range combine to one of its own, so a single pass yields a table with a row for each range; combined in file order they tell how
each range begins. Then every range cuts its lines into records by itself. At most one record of a range goes on into the next:
only these pieces are brought together across ranges. Records are parsed with the reader's own rules by ``from_csv``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.operators.scale import checkpointed
from threadloom.schemas import POSITION, RAW_CSV

QUOTE = '"'
DELIMITER = ","
#: Ranges whose beginnings are sent to all tasks, about 200 bytes each; more are joined by a shuffle.
BROADCAST_RANGES = 200_000

_OUTSIDE, _INSIDE, _DOUBLED = 0, 1, 2


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, at (first byte of the range), row (ascending within a range)."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("row"),
    )


def leaves_inside(line: Column, inside: bool) -> Column:
    """Whether a reader that comes to the line inside (or outside) of a quoted text is inside one at its end.

    A quote opens a text only at the beginning of a field; elsewhere in an unquoted field it is a character like others.
    Inside, two quotes are one character, and any other quote ends the quoted text.
    """
    cut = F.split(line, QUOTE, -1)
    last = F.size(cut) - 1

    def step(state: Column, k: Column) -> Column:
        before, after = F.get(cut, k - 1), F.get(cut, k)
        opens = F.when(k == 1, before == "").otherwise(F.lit(False)) | F.endswith(before, F.lit(DELIMITER))
        return (
            F.when(state == _OUTSIDE, F.when(opens, F.lit(_INSIDE)).otherwise(F.lit(_OUTSIDE)))
            .when(state == _DOUBLED, F.lit(_INSIDE))
            .otherwise(F.when((after == "") & (k < last), F.lit(_DOUBLED)).otherwise(F.lit(_OUTSIDE)))
        )

    start = _INSIDE if inside else _OUTSIDE
    walked = F.aggregate(F.sequence(F.lit(1), last), F.lit(start), step)
    return F.when(F.contains(line, F.lit(QUOTE)), walked == _INSIDE).otherwise(F.lit(inside))


def _with_functions(lines: DataFrame) -> DataFrame:
    return lines.withColumns({"from_outside": leaves_inside(F.col("value"), False), "from_inside": leaves_inside(F.col("value"), True)})


def _comes_inside(by: list[str], order: str, begins: Column) -> Column:
    """Whether a row's reader comes in inside a quoted text: the functions of all rows before it, applied to how the first begins.

    A function either keeps what it is given, or exchanges the two, or leaves one of them whatever it is given. So the
    last row of the third kind decides, and the number of exchanges since then.
    """
    sofar = Window.partitionBy(*by).orderBy(order)
    earlier = sofar.rowsBetween(Window.unboundedPreceding, -1)
    exchanges = (F.col("from_outside") & ~F.col("from_inside")).cast("bigint")
    fixed = F.col("from_outside") == F.col("from_inside")
    mark = F.when(fixed, F.struct(F.col("from_outside").alias("left"), F.col("exchanged").alias("exchanged")))
    decided = F.last(mark, ignorenulls=True).over(earlier)
    before = F.col("exchanged") - exchanges
    since = before - F.coalesce(decided["exchanged"], F.lit(0))
    return F.coalesce(decided["left"], begins) != (since % 2 == 1)


def _exchanged(by: list[str], order: str) -> Column:
    return F.sum((F.col("from_outside") & ~F.col("from_inside")).cast("bigint")).over(Window.partitionBy(*by).orderBy(order))


def ranges(lines: DataFrame) -> DataFrame:
    """One row per byte range: file, at, whether it begins inside a quoted text, and whether any text in it goes over a line end.

    One pass over the feed. A range is read by one task, which combines its lines before anything is shuffled.
    """
    changes = F.col("from_outside") | ~F.col("from_inside")
    found = _with_functions(lines).groupBy("file", "at").agg(
        F.array_sort(F.collect_list(F.when(changes, F.struct("row", "from_outside", "from_inside")))).alias("changes")
    )

    def through(begins: bool) -> Column:
        return F.aggregate(
            "changes", F.lit(begins), lambda state, x: F.when(state, x["from_inside"]).otherwise(x["from_outside"])
        )

    found, _ = checkpointed(
        found.select("file", "at", (F.size("changes") > 0).alias("breaks"), through(False).alias("from_outside"), through(True).alias("from_inside"))
    )
    counted = found.withColumn("exchanged", _exchanged(["file"], "at"))
    begins = _comes_inside(["file"], "at", F.lit(False)).alias("begins_inside")
    return counted.select("file", "at", begins, "breaks")


def records(lines: DataFrame, known: DataFrame) -> DataFrame:
    """The feed's records, each with its file, range and row: lines, or several joined where quoted texts go over line ends."""
    by = ["file", "at"]
    if known.count() <= BROADCAST_RANGES:
        known = F.broadcast(known)
    placed = _with_functions(lines).join(known, by).withColumn("exchanged", _exchanged(by, "row"))
    placed = placed.withColumn("inside", _comes_inside(by, "row", F.col("begins_inside")))
    goes_on = F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside"))
    upto = Window.partitionBy(*by).orderBy("row")
    placed = placed.withColumn("goes_on", goes_on).withColumn("number", F.sum((~F.col("inside")).cast("bigint")).over(upto))
    whole = placed.where("NOT inside AND NOT goes_on").select(*by, "row", "value")
    # Rows of a range are together already, so joining the lines of its longer records needs no further exchange.
    joined = placed.where("inside OR goes_on").groupBy(*by, "number").agg(
        F.min("row").alias("row"),
        F.expr(r"listagg(value, '\n') WITHIN GROUP (ORDER BY row)").alias("value"),
        F.max(F.struct("row", "goes_on"))["goes_on"].alias("open"),
    )
    joined, _ = checkpointed(joined)
    inner = joined.where("number > 0 AND NOT open").select(*by, "row", "value")
    # What is left: at most one piece at either end of a range. Number 0 goes on with what an earlier range began.
    pieces = joined.where("number = 0 OR open").withColumn(
        "record", F.sum(F.when(F.col("number") > 0, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("at", "number"))
    )
    across = pieces.groupBy("file", "record").agg(
        F.min(F.struct("at", "row")).alias("start"), F.expr(r"listagg(value, '\n') WITHIN GROUP (ORDER BY at, number)").alias("value")
    ).select("file", F.col("start.at").alias("at"), F.col("start.row").alias("row"), "value")
    return whole.unionByName(inner).unionByName(across)


def parsed(cut: DataFrame, schema: str = RAW_CSV) -> DataFrame:
    """Columns of the records, and their position. The first record of each file is its header; empty records are skipped.

    A file whose header ends with carriage return and line feed has both at its line ends, also at those in quoted texts.
    """
    first = F.min(F.struct("row", F.endswith("value", F.lit("\r")).alias("returns")))
    headers = cut.where("at = 0").groupBy("file").agg(first.alias("header"))
    marked = cut.join(headers if headers.count() > BROADCAST_RANGES else F.broadcast(headers), "file")
    value = F.regexp_replace("value", r"\r$", "")
    value = F.when(F.col("header.returns"), F.replace(value, F.lit("\r\n"), F.lit("\n"))).otherwise(value)
    body = marked.withColumn("value", value).where("(at > 0 OR row > header.row) AND value != ''")
    options = {"quote": QUOTE, "escape": QUOTE, "sep": DELIMITER, "multiLine": "true"}
    fields = body.select(F.from_csv("value", schema, options).alias("fields"), F.struct("file", "at", "row").alias(POSITION))
    return fields.select("fields.*", POSITION)


def read_csv(spark: SparkSession, path: str, multiline: bool | None = None, schema: str = RAW_CSV, position: bool = False) -> DataFrame:
    """The feed's rows, read by many tasks per file; with ``position``, also where each stands.

    Whether quoted texts go over line ends is found out in one pass over the lines, unless ``multiline`` says it. Only if they do
    are records put together from lines. Records end at line feeds, with or without a carriage return before them.
    """
    if multiline is not False:
        lines = _lines(spark, path)
        known, found = checkpointed(ranges(lines), breaking=F.count_if("breaks"))
        if multiline or found["breaking"]:
            rows = parsed(records(lines, known.drop("breaks")), schema)
            return rows if position else rows.drop(POSITION)
    reader = spark.read.schema(schema).option("header", True).option("quote", QUOTE).option("escape", QUOTE)
    rows = reader.csv(path)
    if not position:
        return rows
    where = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("row")
    )
    return rows.select("*", where.alias(POSITION))
