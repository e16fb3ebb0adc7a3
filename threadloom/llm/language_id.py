"""Languages of texts by sparse multinomial logistic regression on TF-IDF character n-grams.

A text is lower-cased, every run of characters that are no letters becomes one word boundary, and its n-grams of one to four
characters are hashed into 65,536 numbers. A number's value is (1 + log count) times its inverse document frequency; the
values have length one. Document frequencies are counted over all training documents, in Spark. Weights are trained by
follow-the-regularised-leader updates, one document after the other, with an elastic-net penalty (L1 leaves most weights
zero, L2 keeps the rest small). A part of the sample is kept from training: on it a temperature is fitted that divides the
logits, so that the score, the probability of the predicted language, is calibrated.

Training takes at most ``fit_rows`` documents a language; each counts by how many documents of its language it stands for, so
predictions follow the languages' true shares at any size. Texts are read whole, in one pass without a shuffle.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is every text if no language could be learnt; with one
language every other text has it, with score 1; repeated rows are scored alike; an empty table gives no rows. Null languages and
documents without an id are not learnt from; an id that occurs with several languages counts for each.
"""

from __future__ import annotations

import sys
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm import common

FIT_ROWS = 1500
#: Of the sample, every so-manyth document fits the temperature and no weights.
CALIBRATION = 5
ORDERS = (1, 2, 3, 4)
BITS = 16
ROUNDS = 3
UNDETERMINED = "und"
_SIZE = 1 << BITS
#: Characters hashed at a time.
SLICE = 1 << 20
#: Document frequencies are added up in so many pieces.
_PIECES = 64
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


class _Letters:
    """Whether a code point is a letter, for arrays of code points; built when first asked."""

    table: np.ndarray | None = None

    @classmethod
    def among(cls, codes: np.ndarray) -> np.ndarray:
        if cls.table is None:
            cls.table = np.fromiter((chr(code).isalpha() for code in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
        return cls.table[codes]


def counts(text: str | None) -> np.ndarray | None:
    """How often each of the hashed n-grams occurs; None for a text without letters."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _Letters.among(codes) if len(codes) else np.zeros(0, bool)
    if not letter.any():
        return None
    codes = np.where(letter, codes, 0)
    kept = codes[letter | np.concatenate([[True], letter[:-1]])]  # the first of each run of other characters
    kept = np.pad(kept, (int(kept[0] != 0), int(kept[-1] != 0))).astype(np.uint32)  # a boundary at both ends
    found = None
    for at in range(0, len(kept), SLICE):
        part = kept[at : at + SLICE + ORDERS[-1] - 1]
        starts = min(SLICE, len(part))
        rolled, hashed = np.zeros(len(part), np.uint32), []
        for n in ORDERS:
            rolled = rolled[: len(part) - n + 1] + part[n - 1 :] * _FACTORS[n - 1]
            if not len(rolled):
                break
            mixed = (rolled[:starts] ^ (rolled[:starts] >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
            hashed.append((mixed ^ (mixed >> np.uint32(13))) >> np.uint32(32 - BITS))
        part = np.bincount(np.concatenate(hashed), minlength=_SIZE)
        found = part if found is None else found + part
    return found


def features(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The numbers of the text's n-grams, ascending, and their TF-IDF values, of length one together."""
    found = counts(text)
    if found is None:
        return None
    numbers = np.flatnonzero(found)
    values = (1 + np.log(found[numbers])) * idf[numbers]
    return numbers, values / max(float(np.sqrt((values * values).sum())), 1e-12)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of the texts each number occurs, and the number of texts with a letter."""
    schema = pa.schema([("piece", pa.int64()), ("texts", pa.int64()), ("found", pa.binary())])
    width = _SIZE // _PIECES

    def tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(_SIZE, np.int64), 0
        for batch in common.slices(batches):
            for text in batch.column("text").to_pylist():
                found = counts(text)
                if found is not None:
                    total += found > 0
                    known += 1
        if known:
            pieces = [total[k * width : (k + 1) * width].tobytes() for k in range(_PIECES)]
            yield common.batch_of(schema, [list(range(_PIECES)), [known] * _PIECES, pieces])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(width, np.int64), 0
        for batch in batches:
            known += sum(batch.column("texts").to_pylist())
            for raw in batch.column("found").to_pylist():
                total += np.frombuffer(raw, np.int64)
        yield common.batch_of(schema, [[key[0].as_py()], [known], [total.tobytes()]])

    layout = "piece bigint, texts bigint, found binary"
    rows = common.mapped(texts.select("text"), tally, layout).groupBy("piece").applyInArrow(add, layout).collect()  # _PIECES rows
    if not rows:
        return np.zeros(_SIZE, np.int64), 0
    rows.sort(key=lambda row: row.piece)
    return np.concatenate([np.frombuffer(row.found, np.int64) for row in rows]), rows[0].texts


@dataclass(frozen=True)
class Rates:
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.05


@dataclass(frozen=True)
class Model:
    """Languages; inverse document frequencies; weights [number, language] and a bias for each; the temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, numbers: np.ndarray, values: np.ndarray) -> np.ndarray:
        return (self.weights[numbers] * values[:, None]).sum(0) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        found = features(text, self.idf) if self.languages else None
        if found is None:
            return UNDETERMINED, 0.0
        shares = softmax(self.logits(*found)[None], self.temperature)[0]
        best = int(shares.argmax())
        return self.languages[best], float(shares[best])


def softmax(logits: np.ndarray, temperature: float = 1.0) -> np.ndarray:
    scaled = logits / temperature
    scaled = np.exp(scaled - scaled.max(1, keepdims=True))
    return scaled / scaled.sum(1, keepdims=True)


Example = tuple[np.ndarray, np.ndarray, int, float]  # numbers, values, language, weight


def train(examples: list[Example], languages: int, rates: Rates = Rates(), rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases after per-coordinate FTRL-proximal updates over all examples in turn."""
    z, n = np.zeros((_SIZE + 1, languages)), np.zeros((_SIZE + 1, languages))  # the last row is the bias, not penalised by L1
    l1 = np.full((_SIZE + 1, 1), rates.l1)
    l1[_SIZE] = 0.0

    def leader(at) -> np.ndarray:
        w = (np.sign(z[at]) * l1[at] - z[at]) / ((rates.beta + np.sqrt(n[at])) / rates.alpha + rates.l2)
        return np.where(np.abs(z[at]) <= l1[at], 0.0, w)

    for _ in range(rounds):
        for numbers, values, language, weight in examples:
            at, x = np.append(numbers, _SIZE), np.append(values, 1.0)
            w = leader(at)
            gap = softmax((w * x[:, None]).sum(0)[None])[0]
            gap[language] -= 1.0
            slope = x[:, None] * (gap * weight)
            squares = slope * slope
            step = (np.sqrt(n[at] + squares) - np.sqrt(n[at])) / rates.alpha
            z[at] += slope - step * w
            n[at] += squares
    found = leader(slice(None))
    return found[:_SIZE], found[_SIZE]


def fitted_temperature(logits: np.ndarray, languages: np.ndarray, weights: np.ndarray) -> float:
    """The temperature of the least weighted log loss, between 1/20 and 20, by golden sections of its logarithm."""
    if not len(logits):
        return 1.0

    def loss(log_temperature: float) -> float:
        shares = softmax(logits, float(np.exp(log_temperature)))[np.arange(len(logits)), languages]
        return float(-(weights * np.log(np.maximum(shares, 1e-300))).sum())

    low, high, ratio = -np.log(20.0), np.log(20.0), (5**0.5 - 1) / 2
    while high - low > 1e-4:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def sample(docs: DataFrame, held_out: Column, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, text, lang and weight of at most ``fit_rows`` documents a language, chosen by a hash of the id.

    Ids are counted and chosen without their texts; a repeated id and language counts once, with the smaller text.
    """
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out)
    known = known.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    total = known.groupBy("lang").count()
    shares = F.broadcast(total.select("lang", F.lit(fit_rows * 1.5).alias("wanted"), "count"))  # a row for each language
    ticket = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.select("doc_id", "lang").distinct().join(shares, "lang").where(ticket < F.col("wanted") / F.col("count"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = drawn.withColumn("at", F.row_number().over(order)).where(F.col("at") <= fit_rows)
    taken = chosen.groupBy("lang").agg(F.count("*").alias("taken"))
    chosen = chosen.join(F.broadcast(taken), "lang").select("doc_id", "lang", (F.col("count") / F.col("taken")).alias("weight"))
    return known.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(
        F.min("text").alias("text"), F.max("weight").alias("weight")
    )


def fit(docs: DataFrame, held_out: Column, fit_rows: int = FIT_ROWS, rates: Rates = Rates()) -> Model:
    """A model from the text and language of documents outside the held-out fold; without languages if there are none."""
    spark = docs.sparkSession
    frequencies, texts = document_frequencies(docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out))
    idf = np.log((1 + texts) / (1 + frequencies)) + 1
    sent = spark.sparkContext.broadcast(idf)
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("weight", pa.float64()), ("numbers", pa.binary()), ("values", pa.binary())])

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            found = [features(text, sent.value) for text in batch.column("text").to_pylist()]
            rows = [
                (doc, lang, weight, x[0].astype(np.uint16).tobytes(), x[1].astype(np.float32).tobytes())
                for doc, lang, weight, x in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "lang", "weight")), found)
                if x is not None
            ]
            if rows:
                yield common.batch_of(schema, list(map(list, zip(*rows))))

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        rows.sort(key=lambda row: (zlib.crc32(str(row["doc_id"]).encode()), row["doc_id"], row["lang"]))
        if not rows:
            return
        languages = sorted({row["lang"] for row in rows})
        place, scale = {lang: k for k, lang in enumerate(languages)}, len(rows) / sum(row["weight"] for row in rows)
        examples = [
            (np.frombuffer(row["numbers"], np.uint16).astype(np.int64), np.frombuffer(row["values"], np.float32).astype(float),
             place[row["lang"]], min(row["weight"] * scale, 10.0))
            for row in rows
        ]
        kept = [x for k, x in enumerate(examples) if k % CALIBRATION or len(examples) < 4 * CALIBRATION]
        weights, bias = train(kept, len(languages), rates)
        model = Model(languages, idf=np.zeros(0), weights=weights, bias=bias)
        apart = [x for k, x in enumerate(examples) if not k % CALIBRATION and len(examples) >= 4 * CALIBRATION]
        logits = np.array([model.logits(x[0], x[1]) for x in apart]).reshape(-1, len(languages))
        heat = fitted_temperature(logits, np.array([x[2] for x in apart], np.int64), np.array([x[3] for x in apart]))
        used = np.flatnonzero(weights.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array([languages], pa.list_(pa.string())), pa.array([heat]), pa.array([used.astype(np.int64).tobytes()], pa.binary()),
             pa.array([weights[used].tobytes()], pa.binary()), pa.array([bias.tobytes()], pa.binary())],
            names=["languages", "temperature", "used", "weights", "bias"],
        )

    described = common.mapped(sample(docs, held_out, fit_rows), describe, "doc_id bigint, lang string, weight double, numbers binary, values binary")
    layout = "languages array<string>, temperature double, used binary, weights binary, bias binary"
    row = common.mapped(described.coalesce(1), learn, layout).first()  # bounded by the sample: one task trains
    if row is None:
        return Model([], idf, np.zeros((_SIZE, 0)), np.zeros(0))
    weights = np.zeros((_SIZE, len(row.languages)))
    weights[np.frombuffer(row.used, np.int64)] = np.frombuffer(row.weights, float).reshape(-1, len(row.languages))
    return Model(list(row.languages), idf, weights, np.frombuffer(row.bias, float), row.temperature)


_MODELS: dict[str, Model] = {}


def with_language(docs: DataFrame, model: Model, name: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """The rows with the predicted language and its probability."""
    used = np.flatnonzero(model.weights.any(1))
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.idf, used, model.weights[used], model.bias, model.temperature))
    key = uuid.uuid4().hex

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _MODELS:
            languages, idf, rows, some, bias, temperature = sent.value
            weights = np.zeros((_SIZE, len(languages)))
            weights[rows] = some
            _MODELS.clear()
            _MODELS[key] = Model(languages, idf, weights, bias, temperature)
        own = _MODELS[key]
        for batch in common.slices(batches):
            found = [own.predict(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                names=[*batch.schema.names, name, score],
            )

    return common.mapped(docs, predict, docs.withColumns({name: F.lit("").cast("string"), score: F.lit(None).cast("double")}).schema)


def report(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    held_out = common.fold(4, 2)
    scored = with_language(docs.select("doc_id", "text"), fit(docs, held_out, fit_rows))
    return scored.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
