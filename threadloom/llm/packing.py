"""Packing of documents into training sequences as a cutting-stock problem, solved by column generation.

Documents longer than a sequence are cut into full sequences and a rest. All pieces are counted by length, in UNIT tokens rounded up:
at most 256 numbers, however many documents there are. A linear program over patterns (ways to fill a sequence) meets
that histogram with the fewest sequences: the simplex method keeps one pattern a length, and a knapsack by dynamic
programming prices new patterns until none pays. Patterns are rounded down; what is left over, at most one copy of each
pattern, is packed by first-fit decreasing. Pieces are ranked within their length, in salted groups so that a frequent length
spreads over tasks, and ranks map to patterns and places in them by a small table.

Defined results: a null or empty text is one token, the end; rows with the same id are packed each on their own; an empty
table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm import common, token_ids

SEQUENCE = 4096
UNIT = 16
#: The linear program ends when it is this close to its bound.
GAP = 1e-4
#: Rows of one salted group of pieces, at least and at most.
GROUP_ROWS = (256, 100_000)

Pattern = tuple[tuple[int, int], ...]  # (length in units, copies), the longest first


def _best_pattern(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of the highest price (unbounded knapsack), by the best value of every capacity."""
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = int(np.searchsorted(sizes, room, side="right"))  # sizes ascend
        value[room], choice[room] = value[room - 1], -1
        if fits:
            worth = value[room - sizes[:fits]] + prices[:fits]
            k = int(worth.argmax())
            if worth[k] > value[room] + 1e-12:
                value[room], choice[room] = worth[k], k
    column, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            column[choice[room]] += 1
            room -= int(sizes[choice[room]])
    return float(value[capacity]), column


def column_generation(demand: dict[int, int], capacity: int, gap: float = GAP) -> list[tuple[Pattern, float]]:
    """Patterns and how often to use them (fractions) so that every size is met exactly, with nearly the fewest uses."""
    sizes = np.array(sorted(demand), np.int64)
    wanted = np.array([demand[size] for size in sizes], float)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(basis))
    amounts = inverse @ wanted
    for turn in range(50 * len(sizes)):
        prices = inverse.sum(0)
        worth, column = _best_pattern(sizes, prices, capacity)
        if worth <= 1 + gap:
            break
        towards = inverse @ column
        rows = np.flatnonzero(towards > 1e-9)
        leave = rows[(amounts[rows] / towards[rows]).argmin()]
        step = amounts[leave] / towards[leave]
        amounts = np.maximum(amounts - step * towards, 0)
        amounts[leave] = step
        basis[:, leave] = column
        pivot = inverse[leave] / towards[leave]
        inverse -= np.outer(towards, pivot)
        inverse[leave] = pivot
        if turn % 50 == 49:  # against rounding errors
            inverse = np.linalg.inv(basis)
            amounts = np.maximum(inverse @ wanted, 0)
    return [
        (tuple((int(sizes[k]), int(column[k])) for k in np.flatnonzero(column)[::-1]), float(amount))
        for column, amount in zip(basis.T, amounts)
    ]


def first_fit_decreasing(left: dict[int, int], capacity: int) -> list[Pattern]:
    rooms: list[int] = []
    held: list[dict[int, int]] = []
    for size in sorted(left, reverse=True):
        for _ in range(left[size]):
            k = next((k for k, room in enumerate(rooms) if room >= size), None)
            if k is None:
                rooms.append(capacity)
                held.append({})
                k = len(rooms) - 1
            rooms[k] -= size
            held[k][size] = held[k].get(size, 0) + 1
    return [tuple(x.items()) for x in held]


def plan(demand: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns and whole numbers of uses that meet the demand exactly."""
    demand = {size: count for size, count in demand.items() if count}
    if not demand:
        return []
    left, chosen = dict(demand), []
    for pattern, amount in column_generation(demand, capacity):
        uses = int(amount + 1e-6)
        uses = min([uses, *(left[size] // copies for size, copies in pattern)])
        if uses:
            chosen.append((pattern, uses))
            for size, copies in pattern:
                left[size] -= uses * copies
    return chosen + [(pattern, 1) for pattern in first_fit_decreasing(left, capacity)]


def places(chosen: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(size, first rank, ranks, copies in a sequence, first sequence, first slot) for all sizes of all patterns."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, uses in chosen:
        slot = 0
        for size, copies in pattern:
            first = ranks.get(size, 0)
            rows.append((size, first, uses * copies, copies, sequence, slot))
            ranks[size] = first + uses * copies
            slot += copies
        sequence += uses
    return rows


def pieces(docs: DataFrame, vocabulary: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """Per piece of at most ``sequence`` ids: doc_id, start, length, ids_crc32, doc_tokens."""
    path = vocabulary or token_ids.default_vocabulary()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    schema = pa.schema([(name, pa.int64()) for name in names])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            rows = [
                (doc, at, min(sequence, total - at), zlib.crc32(ids[4 * at : 4 * (at + sequence)]), total)
                for doc, ids in zip(batch.column("doc_id").to_pylist(), token_ids.encoder(path).ids(batch.column("text").to_pylist()))
                for total in [len(ids) // 4]
                for at in range(0, total, sequence)
            ]
            yield common.batch_of(schema, list(map(list, zip(*rows))))

    narrow = docs.select(F.col("doc_id").cast("bigint"), "text")
    return common.mapped(narrow, cut, ", ".join(f"{name} bigint" for name in names))


def pack(docs: DataFrame, vocabulary: str | None = None, sequence: int = SEQUENCE, unit: int = UNIT) -> DataFrame:
    """The pieces with sequence_id and offset."""
    spark = docs.sparkSession
    sized = pieces(docs, vocabulary, sequence).withColumn("size", F.ceil(F.col("length") / unit).cast("int"))
    cut = common.stored(sized.withColumn("row", F.monotonically_increasing_id()))
    demand = {row["size"]: row["count"] for row in cut.groupBy("size").count().collect()}  # at most sequence / unit rows
    table = places(common.in_task(spark, plan, demand, sequence // unit)) if demand else []
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = max(GROUP_ROWS[0], min(GROUP_ROWS[1], sum(demand.values()) // (2 * parts)))
    groups = [(size, -(-count // rows)) for size, count in sorted(demand.items())]
    salts = spark.createDataFrame(groups, "size int, salts bigint")
    salted = cut.join(F.broadcast(salts), "size").withColumn("salt", F.pmod(F.xxhash64("row"), F.col("salts")))
    before = Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counted = salted.groupBy("size", "salt").count().select(
        "size", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier")
    )
    within = Window.partitionBy("size", "salt").orderBy(F.desc("length"), "doc_id", "start", "row")
    ranked = salted.withColumn("place", F.row_number().over(within) - 1).join(counted, ["size", "salt"])
    ranked = ranked.withColumn("rank", F.col("place") + F.col("earlier"))
    where = spark.createDataFrame(
        table, "at_size int, first bigint, ranks bigint, copies bigint, first_sequence bigint, first_slot bigint"
    )  # at most a few patterns a size, and their left-overs
    fits = (F.col("size") == F.col("at_size")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("ranks"))
    nth = F.col("rank") - F.col("first")
    placed = ranked.join(F.broadcast(where), fits).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first_sequence") + F.floor(nth / F.col("copies"))).cast("bigint").alias("sequence_id"),
        (F.col("first_slot") + nth % F.col("copies")).alias("slot"),
    )
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("slot")
