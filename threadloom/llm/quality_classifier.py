"""Quality scores by logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Two views of the word sequence are cut into n-grams of one to three words and hashed into one table: the words themselves
in lower case, and the words' shapes, that is capitals, digits, symbols, closing marks, and whether a word equals the one
before or occurred in the text before. The n-grams of one length in a view weigh together one, each by the root of its share, so
long and short texts are comparable. The proximal FTRL rule updates the few weights that a document touches, one
document after the other, in an order that a hash fixes; L1 regularisation leaves most weights zero. A score is the
logistic of a sparse dot product, computed for whole batches; texts are read once and not shuffled.

Training takes at most ``fit_rows`` documents a class. Defined results: a null or empty text has the score of the intercept;
repeated rows score alike; without labelled rows of both classes every score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm import common

FIT_ROWS = 4000
BITS = 18
ROUNDS = 3
THRESHOLD = 0.5
_SIZE = 1 << BITS
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PHRASE = np.uint64(0xBF58476D1CE4E5B9)
_SYMBOLS = b"#*$%&|<>@^~=+_\\{}[]"
_CLOSING = b".,;:!?"
_DIGITS = b"0123456789"
_REMEMBERED = 300_000


class _Kinds(dict):
    """By word: the hash of the word, and in the last 8 bits its shape."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        letters = word.decode("utf-8", "replace")
        if letters.islower():
            case = 1
        elif letters.isupper():
            case = 4 if len(letters.rstrip(".,;:!?")) == 1 else 3
        else:
            case = 2 if letters.lower() != letters.upper() else 0
        shape = case * 24
        if not word.isalpha():
            shape += min(len(word) - len(word.translate(None, _CLOSING)), 2) * 8
            shape += min(len(word) - len(word.translate(None, _SYMBOLS)), 3) * 2
            shape += len(word) > len(word.translate(None, _DIGITS))
        self[word] = found = zlib.crc32(word.lower()) << 8 | shape
        return found


_KINDS = _Kinds()


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the weights that the text's n-grams have, and their values; different n-grams may share a number."""
    words = (text or "").encode("utf-8", "replace").split()
    if not words:
        return np.zeros(1, np.int64), np.ones(1)
    found = np.fromiter(map(_KINDS.__getitem__, words), np.uint64, len(words))
    hashes, shapes = found >> np.uint64(8), found & np.uint64(255)
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    seen = np.ones(len(words), np.uint64)
    seen[order[fresh]] = 0
    seen[1:][hashes[1:] == hashes[:-1]] = 2
    begins = np.flatnonzero(fresh)
    views = [(ranked[begins] + np.uint64(1 << 40), np.diff(np.append(begins, len(words))))]
    phrase, gram = hashes, shapes * np.uint64(3) + seen
    shapes = gram
    for n in (1, 2, 3):
        if n > 1:
            if len(words) < n:
                break
            phrase = phrase[:-1] * _PHRASE + hashes[n - 1 :]
            gram = gram[:-1] * np.uint64(1009) + shapes[n - 1 :]
            views.append(np.unique(phrase + np.uint64(n << 40), return_counts=True))
        views.append(np.unique(gram + np.uint64(n << 44), return_counts=True))
    numbers, values = [np.zeros(1, np.int64)], [np.ones(1)]  # number 0 is the intercept
    for codes, counts in views:
        numbers.append(1 + ((codes * _MIX) >> np.uint64(64 - BITS)).astype(np.int64) % (_SIZE - 1))
        values.append(np.sqrt(counts / counts.sum()))
    return np.concatenate(numbers), np.concatenate(values)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The same, ascending and with each number once."""
    numbers, values = grams(text)
    merged, place = np.unique(numbers, return_inverse=True)
    return merged, np.bincount(place, values)


@dataclass(frozen=True)
class Rates:
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], rates: Rates = Rates(), rounds: int = ROUNDS) -> np.ndarray:
    """The weights after per-coordinate FTRL-proximal updates over all examples in turn; both classes weigh the same."""
    z, n = np.zeros(_SIZE), np.zeros(_SIZE)
    labels = np.array([label for _, _, label in examples])
    weight = {label: len(labels) / (2 * max(1, int((labels == label).sum()))) for label in (0, 1)}

    def leader(at: np.ndarray) -> np.ndarray:
        w = (np.sign(z[at]) * rates.l1 - z[at]) / ((rates.beta + np.sqrt(n[at])) / rates.alpha + rates.l2)
        return np.where(np.abs(z[at]) <= rates.l1, 0.0, w)

    for _ in range(rounds):
        for at, values, label in examples:
            w = leader(at)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
            slope = (p - label) * weight[label] * values
            step = (np.sqrt(n[at] + slope * slope) - np.sqrt(n[at])) / rates.alpha
            z[at] += slope - step * w
            n[at] += slope * slope
    return leader(np.arange(_SIZE))


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", fit_rows: int = FIT_ROWS) -> np.ndarray | None:
    """Weights learnt from at most ``fit_rows`` labelled documents a class; None without both classes."""
    chosen = common.sampled_labels(labels, label, held_out, fit_rows)
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int64()), ("numbers", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))])

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            found = [features(text) for text in batch.column("text").to_pylist()]
            yield common.batch_of(schema, [
                batch.column("doc_id"), batch.column("label").cast(pa.int64()),
                pa.array([x.astype(np.int32) for x, _ in found], pa.list_(pa.int32())),
                pa.array([x.astype(np.float32) for _, x in found], pa.list_(pa.float32())),
            ])

    sample = docs.select(F.col("doc_id").cast("bigint"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
    rows = common.mapped(sample, describe, "doc_id bigint, label bigint, numbers array<int>, values array<float>").toArrow()
    examples = [
        (np.array(numbers.values, np.int64), np.array(values.values, float), label, doc)
        for doc, label, numbers, values in zip(rows.column("doc_id").to_pylist(), rows.column("label").to_pylist(),
                                               rows.column("numbers"), rows.column("values"))
    ]
    if len({label for _, _, label, _ in examples}) < 2:
        return None
    examples.sort(key=lambda x: (zlib.crc32(str(x[3]).encode()), x[3], x[0].tobytes()))
    return train([x[:3] for x in examples])


_WEIGHTS: dict[str, np.ndarray] = {}


def with_score(docs: DataFrame, weights: np.ndarray | None, name: str = "quality_score") -> DataFrame:
    """The rows with one more column."""
    if weights is None:
        return docs.withColumn(name, F.lit(0.5))
    some = np.flatnonzero(weights)
    sent = docs.sparkSession.sparkContext.broadcast((some.astype(np.int32), weights[some]))
    key = uuid.uuid4().hex

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _WEIGHTS:
            _WEIGHTS.clear()
            _WEIGHTS[key] = np.zeros(_SIZE)
            _WEIGHTS[key][sent.value[0]] = sent.value[1]
        dense = _WEIGHTS[key]
        for batch in common.slices(batches):
            found = [grams(text) for text in batch.column("text").to_pylist()]
            sums = np.array([dense[numbers] @ values for numbers, values in found])
            scores = 1 / (1 + np.exp(-np.clip(sums, -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name])

    return common.mapped(docs, score, docs.withColumn(name, F.lit(None).cast("double")).schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = common.fold(3, 1)
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels, held_out))
    return scored.select(
        "doc_id", held_out.alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
