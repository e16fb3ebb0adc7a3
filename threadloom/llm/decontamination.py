"""Benchmark decontamination by Wu-Manber multi-pattern search, with words as the alphabet.

Patterns are the windows of 10 consecutive words of the benchmark items (a shorter item is one window). The words of the
benchmark are numbered; a document becomes an array of numbers, 0 for any other word. Per pattern length, a table by the
hash of a block of words tells how far a search may move on when it sees that block: blocks that end no pattern allow a
step over many words. Where the step is 0, the hash of the block leads to a bucket of patterns with that suffix, and their
numbers are compared with the text. All searches of a batch of documents advance together in numpy, a lane for each
stretch of a document.

Documents are not shuffled. The benchmark is sent to the tasks in blocks of at most ``block_words`` words, a proven bound;
a larger benchmark takes several passes over the documents, whose hits are united by a number that each row is given and stored with.

Defined results: null and empty texts have no words, hence no hits; null or empty items have no windows; items with the
same id count once; items without an id make hits like others, but are not named or counted among the items; an empty benchmark
contaminates nothing; documents are judged each on their own, also if they have no id or share one.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import common

WINDOW = 10
#: Words of benchmark items that one pass over the documents searches for.
BLOCK_WORDS = 1_000_000
#: Words of a document that one lane of the search covers.
LANE = 512

_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_LETTERS).split()


class _Length:
    """Tables for the patterns of one length."""

    def __init__(self, patterns: np.ndarray, owners: list[np.ndarray]):
        self.size = m = patterns.shape[1]
        self.block = b = min(2, m)
        self.patterns, self.owners = patterns, owners
        self.bits = max(12, int(np.ceil(np.log2(len(patterns) * m + 1))) + 2)
        self.shift = np.full(1 << self.bits, m - b + 1, np.int32)
        for end in range(b, m + 1):  # a block that ends at ``end`` lets the pattern's end be m - end words away
            np.minimum.at(self.shift, self.hashed([patterns[:, end - b + k] for k in range(b)]), m - end)
        suffix = self.hashed([patterns[:, m - b + k] for k in range(b)])
        self.order = np.argsort(suffix, kind="stable")
        self.first = np.searchsorted(suffix[self.order], np.arange((1 << self.bits) + 1))

    def hashed(self, words: list[np.ndarray]) -> np.ndarray:
        value = np.zeros(len(words[0]), np.uint64)
        for word in words:
            value = (value + word.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        return (value >> np.uint64(64 - self.bits)).astype(np.int64)

    def occurrences(self, text: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First positions and pattern numbers of all occurrences inside the stretches that ``bounds`` delimits."""
        m, b = self.size, self.block
        starts, stops = [], []
        for low, high in zip(bounds[:-1], bounds[1:]):
            for at in range(low, high - m + 1, LANE):
                starts.append(at + m - 1)
                stops.append(min(at + LANE + m - 1, high))  # ends of windows that begin in this lane
        at, stop = np.array(starts, np.int64), np.array(stops, np.int64)
        found_at, found = [], []
        while len(at):
            key = self.hashed([text[at - b + 1 + k] for k in range(b)])
            step = self.shift[key]
            ends = np.flatnonzero(step == 0)
            if len(ends):
                low, count = self.first[key[ends]], self.first[key[ends] + 1] - self.first[key[ends]]
                where = np.repeat(at[ends] - m + 1, count)
                rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                which = self.order[np.repeat(low, count) + rank]
                for k in range(m):  # direct comparison, word by word
                    same = text[where + k] == self.patterns[which, k]
                    where, which = where[same], which[same]
                found_at.append(where)
                found.append(which)
            at = at + np.maximum(step, 1)
            alive = at < stop
            at, stop = at[alive], stop[alive]
        none = np.zeros(0, np.int64)
        return np.concatenate([*found_at, none]), np.concatenate([*found, none])


class Matcher:
    """Search tables for windows of the given items."""

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        self.items: list[str | None] = []
        windows: dict[tuple[int, ...], set[int]] = {}
        for number, (item, words) in enumerate(items):
            self.items.append(item)
            ids = [self.numbers.setdefault(word, len(self.numbers) + 1) for word in words]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                windows.setdefault(tuple(ids[at : at + window]), set()).add(number)
        by_length: dict[int, list[tuple[int, ...]]] = {}
        for found in windows:
            by_length.setdefault(len(found), []).append(found)
        self.lengths = [
            _Length(np.array(found, np.int32), [np.array(sorted(windows[x]), np.int64) for x in found])
            for _, found in sorted(by_length.items())
        ]

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, int, list[str]]]:
        """Per text: its words, its words inside any occurrence, the items with occurring windows."""
        bounds, parts = [0], []
        get = self.numbers.get
        for text in texts:
            words = words_of(text)
            parts.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
            bounds.append(bounds[-1] + len(words))
        whole, edges = np.concatenate([*parts, np.zeros(0, np.int32)]), np.array(bounds, np.int64)
        edge = np.zeros(len(whole) + 1, np.int64)
        owners: dict[int, set[int]] = {}
        for length in self.lengths:
            at, which = length.occurrences(whole, edges)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + length.size, -1)
            rows = np.searchsorted(edges, at, side="right") - 1
            for row, pattern in set(zip(rows.tolist(), which.tolist())):
                owners.setdefault(row, set()).update(length.owners[pattern].tolist())
        self.hit = np.cumsum(edge[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(self.hit)])
        for row in range(len(texts)):
            low, high = bounds[row], bounds[row + 1]
            yield high - low, int(total[high] - total[low]), sorted({self.items[x] for x in owners.get(row, ())} - {None})

    def spans(self, low: int, high: int) -> list[int]:
        """Of the last search, the hit words between two places, as alternating begins and ends."""
        return np.flatnonzero(np.diff(np.concatenate([[0], self.hit[low:high].astype(np.int8), [0]]))).tolist()


_BUILT: dict[str, Matcher] = {}


def _matcher(name: str, items) -> Matcher:
    """Built once in a worker for a broadcast; only the last is kept."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Matcher(items.value)
    return _BUILT[name]


def _blocks(benchmark: DataFrame, block_words: int) -> list[DataFrame]:
    """The items' words, long items in overlapping parts, in blocks of about ``block_words`` words."""
    part = max(WINDOW, block_words // 8)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (item, b" ".join(words[at : at + part + WINDOW - 1]), min(len(words) - at, part + WINDOW - 1))
                for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for words in [words_of(text)]
                for at in range(0, max(1, len(words) - WINDOW + 1) if words else 0, part)
            ]
            yield pa.RecordBatch.from_pydict(
                {"item": pa.array([r[0] for r in rows], pa.string()), "words": pa.array([r[1] for r in rows], pa.binary()),
                 "n": pa.array([r[2] for r in rows], pa.int64())}
            )

    items = benchmark.select(F.col("item_id").cast("string"), "text")
    cut_up = common.stored(common.mapped(items, cut, "item string, words binary, n bigint"))
    n = -(-(cut_up.agg(F.sum("n")).first()[0] or 0) // block_words)
    if n <= 1:
        return [cut_up] * n
    at = F.pmod(F.xxhash64("item", "words"), F.lit(2 * n))  # twice as many, so that none is much above the bound
    return [cut_up.where(at == k) for k in range(2 * n)]


def _annotated(docs: DataFrame, block: DataFrame | None, name: str) -> DataFrame:
    """The rows with one more column, a struct: n_words, n_hit, items, and the hit words as begins and ends in turn."""
    spark = docs.sparkSession
    rows = block.select("item", "words").collect() if block is not None else []  # at most about BLOCK_WORDS words
    sent = spark.sparkContext.broadcast([(row.item, bytes(row.words).split()) for row in rows])
    tables = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    kind = "struct<n_words: bigint, n_hit: bigint, items: array<string>, spans: array<bigint>>"
    inner = pa.struct(
        [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.int64()))]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            matcher = _matcher(tables, sent)
            results, at = [], 0
            for n_words, n_hit, items in list(matcher.search(batch.column("text").to_pylist())):
                spans = matcher.spans(at, at + n_words) if n_hit else []
                results.append({"n_words": n_words, "n_hit": n_hit, "items": items, "spans": spans})
                at += n_words
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(results, inner)], names=[*batch.schema.names, name])

    return common.mapped(docs, run, docs.withColumn(name, F.lit(None).cast(kind)).schema)


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """The rows with a number of their own, stored: every pass over them finds the same numbers."""
    return common.stored(docs.withColumn(name, F.monotonically_increasing_id()))


def _hits(numbered: DataFrame, name: str, blocks: list[DataFrame]) -> DataFrame:
    """Per number of a row with hits in any block: the united spans and items."""
    narrow = numbered.select(F.col(name).alias("row"), "text")
    each = [_annotated(narrow, block, "found").where("found.n_hit > 0").select("row", "found.*") for block in blocks]
    return (
        functools.reduce(DataFrame.unionByName, each)
        .groupBy("row")
        .agg(
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    )


def search(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, and the sorted ids of items that occur, as text."""
    narrow = docs.select(F.col("doc_id").cast("bigint"), "text")
    blocks = _blocks(benchmark, block_words)
    if len(blocks) <= 1:
        return _annotated(narrow, blocks[0] if blocks else None, "found").select(
            "doc_id", "found.n_words", "found.n_hit", "found.items"
        )
    numbered = _numbered(narrow, "row")
    places = "flatten(transform(sequence(0, size(spans) div 2 - 1), k -> sequence(spans[2 * k], spans[2 * k + 1] - 1)))"
    united = _hits(numbered, "row", blocks).select(
        "row", F.expr(f"cast(size(array_distinct({places})) as bigint)").alias("hit"), "items"
    )
    counted = _annotated(numbered, None, "found").select("row", "doc_id", "found.n_words")
    return counted.join(united, "row", "left").select(
        "doc_id", "n_words", F.coalesce("hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def report(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    joined = F.concat_ws(",", F.array_sort("items"))
    return search(docs, benchmark, block_words).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(joined.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without a hit, with their own columns."""
    blocks = _blocks(benchmark, block_words)
    if len(blocks) <= 1:
        name = common.free_name(docs, "found")
        found = _annotated(docs, blocks[0] if blocks else None, name)
        return found.where(F.col(name)["n_hit"] == 0).select(*docs.columns)
    name = common.free_name(docs, "row")
    numbered = _numbered(docs, name)
    hit = _hits(numbered, name, blocks).select(F.col("row").alias(name))
    return numbered.join(hit, name, "left_anti").select(*docs.columns)
