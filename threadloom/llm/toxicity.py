"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels exist per document only, so token labels are derived first: a word, or a word's beginning, that occurs in far more
toxic than clean training documents than chance allows is toxic where it occurs in a toxic document. The whole texts so
labelled train the field: hashed features of the word, its beginnings and its ending, and transitions between the
two tags, by gradient steps on the log-likelihood with forward-backward expectations, which tasks sum over their texts in every
round. For a document, forward-backward gives
each token's marginal probability of being toxic; their sum and maximum give the document's score through a logistic link
fitted on the training documents, and tokens of a marginal of at least a half give the offending offsets. The link's intercept
is corrected for the share of each class that was sampled, so that the threshold means the same at any number of labels.

Only labelled training rows are sampled (``fit_rows`` a class); every text is learnt from and scored as a whole, and scored
in one pass without a shuffle. Chains of any length run in blocks of 2 x 2 matrix products.

Defined results: a null or empty text has the score of a text without toxic tokens; repeated rows are scored alike; without
labelled rows of both classes every score is 0; an empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm import common

FIT_ROWS = 5000
#: Gradient steps of the field, each a job over the training texts.
ROUNDS = 30
#: Parts of the training texts, so that tasks share a step.
FIT_TASKS = 16
#: Tokens of a chain in training; a longer text goes on in a chain of its own.
CHAIN = 1 << 16
#: Tokens after which a task's training row is full; bounds the memory of a step.
GROUP = 1 << 18
BITS = 18
THRESHOLD = 0.3
#: Longest lineage of one matrix product; tokens of a batch are arranged in blocks of this length.
BLOCK = 128
#: Steps between two rescalings. A step's weights lie within e^±40, so four of them, and products of two such, are in range.
_RESCALE = 4
_CACHE = 200_000

_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def _masked(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace").translate(_LETTERS)


def tokens(text: str | None) -> list[bytes]:
    return _masked(text).split()


def units(word: bytes) -> list[bytes]:
    """The word and its beginnings: what lexical evidence is counted for."""
    return [word, *(b"^" + word[:n] for n in (4, 5, 6) if len(word) >= n)]


_MASK = (1 << BITS) - 1
_BEGINNINGS = (3, 4, 5, 6, 8)
_FEATURES = 3 + len(_BEGINNINGS)


def features(word: bytes) -> list[int]:
    """Hashed numbers of the word, its ending, its length and its beginnings."""
    crc = zlib.crc32
    return [crc(word, 1) & _MASK, crc(word[-3:], 2) & _MASK, min(len(word), 12)] + [
        crc(word[:n], n) & _MASK for n in _BEGINNINGS
    ]


@dataclass
class Field:
    """Weights of the tag 'toxic' against 'clean' by feature; log transition weights [from, to]; start weights; link."""

    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray
    link: np.ndarray

    def emissions(self, words: list[bytes]) -> np.ndarray:
        numbers = np.array([features(word) for word in words], np.int64).reshape(-1, _FEATURES)
        return np.clip(self.weights[numbers].sum(1), -30, 30)


def marginals(emission: np.ndarray, first: np.ndarray, field: Field) -> np.ndarray:
    """Probability of the tag 'toxic' at each token of all chains; ``first`` marks where a chain begins."""
    n = len(emission)
    if not n:
        return np.zeros(0)
    width = min(BLOCK, n)
    lanes = -(-n // width)
    odds = np.ones(lanes * width)
    odds[:n] = np.exp(emission)
    begin = np.ones(lanes * width, bool)
    begin[:n] = first
    move, start = np.exp(field.transitions - field.transitions.max()), np.exp(field.start - field.start.max())
    # step[i][j]: weight of going from tag i to tag j and emitting there; a chain's first token forgets what was before.
    # Places come first, lanes second: a pass takes one place of all lanes at a time, which then lie together.
    step = [[np.where(begin, start[j], move[i][j]) * (odds if j else 1.0) for j in (0, 1)] for i in (0, 1)]
    (s00, s01), (s10, s11) = [[np.ascontiguousarray(x.reshape(lanes, width).T) for x in row] for row in step]

    def scaled(t, *parts):  # only ratios count, so now and then is enough to stay in range
        if t % _RESCALE:
            return parts
        total = sum(parts)
        return tuple(part / total for part in parts)

    # forward: the product of each lane, then the state before each lane, then each token
    p00, p01, p10, p11 = np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)
    for t in range(width):
        p00, p01 = p00 * s00[t] + p01 * s10[t], p00 * s01[t] + p01 * s11[t]
        p10, p11 = p10 * s00[t] + p11 * s10[t], p10 * s01[t] + p11 * s11[t]
        p00, p01, p10, p11 = scaled(t, p00, p01, p10, p11)
    a, before = (0.5, 0.5), []
    for w00, w01, w10, w11 in zip(p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist()):
        before.append(a)
        x, y = a[0] * w00 + a[1] * w10, a[0] * w01 + a[1] * w11
        a = (x / (x + y), y / (x + y))
    a0, a1 = np.array(before).T
    forward0, forward1 = np.empty((width, lanes)), np.empty((width, lanes))
    for t in range(width):
        a0, a1 = scaled(t, a0 * s00[t] + a1 * s10[t], a0 * s01[t] + a1 * s11[t])
        forward0[t], forward1[t] = a0, a1
    # backward: the same from the right; b is the weight of what follows, given the tag
    q00, q01, q10, q11 = np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)
    for t in range(width - 1, -1, -1):
        q00, q10 = s00[t] * q00 + s01[t] * q10, s10[t] * q00 + s11[t] * q10
        q01, q11 = s00[t] * q01 + s01[t] * q11, s10[t] * q01 + s11[t] * q11
        q00, q01, q10, q11 = scaled(t, q00, q01, q10, q11)
    b, after = (0.5, 0.5), []
    for w00, w01, w10, w11 in zip(*(x[::-1].tolist() for x in (q00, q01, q10, q11))):
        after.append(b)
        x, y = w00 * b[0] + w01 * b[1], w10 * b[0] + w11 * b[1]
        b = (x / (x + y), y / (x + y))
    b0, b1 = np.array(after[::-1]).T
    result = np.empty((width, lanes))
    for t in range(width - 1, -1, -1):
        x, y = forward0[t] * b0, forward1[t] * b1
        result[t] = y / (x + y)
        b0, b1 = scaled(t, s00[t] * b0 + s01[t] * b1, s10[t] * b0 + s11[t] * b1)
    return result.T.ravel()[:n]


def expectations(field: Field, table: np.ndarray, words: np.ndarray, tags: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What a step needs of some chains, as sums: the slope of each weight, transitions and
    starts seen less those expected.

    ``words`` are rows of the table of features, ``lengths`` those of the chains. Two of three tokens hide the word itself,
    so that its beginnings learn to stand for forms that training has not seen.
    """
    n = len(words)
    begins = np.cumsum(lengths) - lengths
    first = np.zeros(n, bool)
    first[begins] = True
    hides = (np.arange(n) - np.repeat(begins, lengths)) % 3 != 0
    own = field.weights[table[:, 0]]
    rest = field.weights[table[:, 1:]].sum(1)
    emission = np.clip(rest[words] + np.where(hides, 0.0, own[words]), -30, 30)
    m = marginals(emission, first, field)
    gap = tags - m
    shown = np.bincount(words[~hides], gap[~hides], len(table))
    every = shown + np.bincount(words[hides], gap[hides], len(table))
    slope = np.bincount(table[:, 0], shown, 1 << BITS)
    for column in table.T[1:]:
        slope += np.bincount(column, every, 1 << BITS)
    pair = ~first[1:]
    seen = np.bincount(2 * tags[:-1][pair] + tags[1:][pair], minlength=4).reshape(2, 2)
    began = np.bincount(tags[first], minlength=2)
    starting = began - [(1 - m[first]).sum(), m[first].sum()]
    return np.concatenate([slope, (seen - _pairs(first, m, field)).ravel(), starting])


class Ascent:
    """A field on its way to maximum likelihood, by AdaGrad steps on all chains together.

    Slopes are sums over tokens: it takes some ``least`` of them to move a weight at full ``rate``, however many texts there are.
    """

    def __init__(self, rate: float = 0.5, decay: float = 0.25, least: float = 25.0):
        self.field = Field(np.zeros(1 << BITS), np.zeros((2, 2)), np.zeros(2), np.zeros(4))
        self.squares, self.move_squares, self.start_squares = (np.full(size, least**2) for size in (1 << BITS, (2, 2), 2))
        self.rate, self.decay = rate, decay

    def step(self, sums: np.ndarray) -> None:
        field = self.field
        slope = sums[: 1 << BITS] - self.decay * field.weights
        self.squares += slope**2
        field.weights = field.weights + self.rate * slope / np.sqrt(self.squares)
        move, starting = sums[-6:-2].reshape(2, 2), sums[-2:]
        self.move_squares += move**2
        field.transitions = field.transitions + 0.2 * move / np.sqrt(self.move_squares)
        self.start_squares += starting**2
        field.start = field.start + 0.2 * starting / np.sqrt(self.start_squares)


def coded_chains(texts: Iterable[tuple[str | None, int]], lexicon: frozenset[bytes]) -> Iterator[list[bytes]]:
    """Labelled texts as training rows: features by word, the chains' words, their tags, the chains' lengths. A token
    of a toxic text is toxic if the lexicon holds it or a beginning of it."""
    number: dict[bytes, int] = {}
    words_out, tags_out, lengths = [], [], []

    def row() -> list[bytes]:
        table = np.array([features(word) for word in number], np.int32)
        found = [table, np.array(words_out, np.int32), np.array(tags_out, np.int8), np.array(lengths, np.int64)]
        for held in (number, words_out, tags_out, lengths):
            held.clear()
        return [x.tobytes() for x in found]

    for text, toxic in texts:
        words = tokens(text)
        for low in range(0, len(words), CHAIN):
            chain = words[low : low + CHAIN]
            words_out.extend(number.setdefault(word, len(number)) for word in chain)
            tags_out.extend(toxic == 1 and any(unit in lexicon for unit in units(word)) for word in chain)
            lengths.append(len(chain))
            if len(words_out) >= GROUP:
                yield row()
    if lengths:
        yield row()


def _pairs(first: np.ndarray, m: np.ndarray, field: Field) -> np.ndarray:
    """Expected transitions [from, to], from the marginals of neighbours: in a chain, the joint probabilities of two
    neighbours' tags are the one table with their marginals as margins and the odds ratio of the transition weights."""
    inside = ~first[1:]
    a, b = m[:-1][inside], m[1:][inside]
    t = field.transitions
    ratio = float(np.exp(t[0, 0] + t[1, 1] - t[0, 1] - t[1, 0]))
    if abs(ratio - 1) < 1e-9:
        both = a * b
    else:
        s = 1 + (a + b) * (ratio - 1)
        both = (s - np.sqrt(np.maximum(s * s - 4 * ratio * (ratio - 1) * a * b, 0))) / (2 * (ratio - 1))
    c, sa, sb = both.sum(), a.sum(), b.sum()
    return np.array([[len(a) - sa - sb + c, sb - c], [sa - c, c]])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Intercept and slopes by Newton's method with a little shrinkage."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w)), x.T @ (y - p) - 0.05 * w)
    return w


def _summary(m: np.ndarray) -> list[float]:
    """What the document score is made from: the expected number of toxic tokens, and the two surest tokens."""
    if len(m) < 2:
        return [float(np.log1p(m.sum())), float(m.sum()), 0.0]
    second, best = np.partition(m, len(m) - 2)[-2:]
    return [float(np.log1p(m.sum())), float(best), float(second)]


class Scorer:
    def __init__(self, field: Field):
        self.field, self.known = field, {}

    def _emissions(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > _CACHE:
            known.clear()
        fresh = list(set(words).difference(known))
        known.update(zip(fresh, self.field.emissions(fresh).tolist()))
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def batch(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, float]]:
        """Per text: its tokens' marginals, and its score."""
        lists = [tokens(text) for text in texts]
        bounds = np.cumsum([0, *map(len, lists)])
        first = np.zeros(bounds[-1], bool)
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        found = marginals(self._emissions([word for words in lists for word in words]), first, self.field)
        for low, high in zip(bounds[:-1], bounds[1:]):
            m = found[low:high]
            yield m, float(1 / (1 + np.exp(-np.clip(self.field.link @ [1.0, *_summary(m)], -30, 30))))

    @staticmethod
    def offsets(text: str, m: np.ndarray, least: float = 0.5) -> list[tuple[int, int]]:
        """Begin and end, in code points, of runs of toxic tokens."""
        raw = _masked(text)
        places = [found.span() for found in re.finditer(rb"[^ ]+", raw)]
        spans: list[tuple[int, int]] = []
        for k in np.flatnonzero(m >= least):
            low, high = places[k]
            if spans and k and places[k - 1][1] == spans[-1][1]:
                spans[-1] = (spans[-1][0], high)
            else:
                spans.append((low, high))
        source = text.encode("utf-8", "replace")
        return [(len(source[:low].decode("utf-8", "replace")), len(source[:high].decode("utf-8", "replace"))) for low, high in spans]


_SCORERS: dict[str, Scorer] = {}


def _scorer(name: str, sent) -> Scorer:
    if name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[name] = Scorer(sent.value)
    return _SCORERS[name]


def _telling(sample: DataFrame, lexicon: frozenset[bytes]) -> frozenset[bytes]:
    """Units that occur in more toxic than clean documents than chance allows, by Chernoff's bound against as many trials
    as there are units, and in hardly any clean one. Toxic documents with two tokens of ``lexicon`` are left out."""

    def count_units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            tally: dict[bytes, list[int]] = {}
            for text, tag in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                words = tokens(text)
                if tag and sum(any(unit in lexicon for unit in units(word)) for word in words) >= 2:
                    continue
                for unit in {unit for word in set(words) for unit in units(word)} | {b""}:  # b"" counts documents
                    tally.setdefault(unit, [0, 0])[tag] += 1
            rows = list(tally.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(tally), pa.binary()), pa.array([x[0] for x in rows], pa.int64()),
                 pa.array([x[1] for x in rows], pa.int64())], names=["unit", "clean", "toxic"],
            )

    counted = common.mapped(sample, count_units, "unit binary, clean bigint, toxic bigint")
    tally = common.stored(counted.groupBy("unit").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    whole = tally.where(F.col("unit") == F.lit(b"")).first()
    if whole is None or not whole.toxic or not whole.clean:
        return frozenset()
    share = whole.toxic / (whole.clean + whole.toxic)
    n = F.col("clean") + F.col("toxic")
    q = F.col("toxic") / n
    gain = n * (q * F.log(q / share) + F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - share))).otherwise(0.0))
    least = float(np.log(max(tally.count(), 2)) + 2)
    telling = tally.where((q >= max(0.9, (1 + share) / 2)) & (gain > least)).select("unit")
    return frozenset(bytes(row.unit) for row in telling.toLocalIterator())  # of bounded documents


def _summed(coded: DataFrame, field: Field) -> np.ndarray:
    """The expectations over all training rows: tasks sum theirs, the driver adds one row of bounded size a task."""
    sent = coded.sparkSession.sparkContext.broadcast(field)
    schema = pa.schema([("places", pa.binary()), ("sums", pa.binary())])
    wide = (1 << BITS) + 6

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(wide)
        for batch in batches:
            for table, words, tags, lengths in zip(*(column.to_pylist() for column in batch.columns)):
                total += expectations(
                    sent.value, np.frombuffer(table, np.int32).reshape(-1, _FEATURES), np.frombuffer(words, np.int32),
                    np.frombuffer(tags, np.int8).astype(np.int64), np.frombuffer(lengths, np.int64),
                )
        some = np.flatnonzero(total)
        yield common.batch_of(schema, [[some.astype(np.int32).tobytes()], [total[some].tobytes()]])

    total = np.zeros(wide)
    rows = common.mapped(coded, sums, "places binary, sums binary").toArrow()  # one a task, of at most FIT_TASKS tasks
    for places, found in zip(*(column.to_pylist() for column in rows.columns)):
        total[np.frombuffer(places, np.int32)] += np.frombuffer(found)
    sent.unpersist()
    return total


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", fit_rows: int = FIT_ROWS) -> Field | None:
    """The field, learnt from at most ``fit_rows`` labelled documents a class; None without both classes."""
    chosen = common.sampled_labels(labels, label, held_out, fit_rows)
    sample = common.stored(
        docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").select("text", "label")
    )
    counts = {row.label: row["count"] for row in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None

    lexicon: frozenset[bytes] = frozenset()
    for _ in range(2):  # the second time only among toxic documents that the first explains with fewer than two tokens
        lexicon = lexicon | _telling(sample, lexicon)

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            pair
            for batch in common.slices(batches)
            for pair in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist())
        )
        for row in coded_chains(rows, lexicon):
            yield common.batch_of(coded_schema, [[x] for x in row])

    coded_schema = pa.schema([(name, pa.binary()) for name in ("features", "words", "tags", "lengths")])
    coded = common.stored(common.mapped(sample.repartition(FIT_TASKS), code, "features binary, words binary, tags binary, lengths binary"))
    climb = Ascent()
    for _ in range(ROUNDS):
        climb.step(_summed(coded, climb.field))
    field = climb.field

    sent = docs.sparkSession.sparkContext.broadcast(field)
    name = uuid.uuid4().hex

    def summarise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            found = [_summary(m) for m, _ in _scorer(name, sent).batch(batch.column("text").to_pylist())]
            columns = [*zip(*found), batch.column("label").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()) for x in columns], names=names)

    names = ["expected", "surest", "second", "label"]
    rows = common.mapped(sample, summarise, ", ".join(f"{x} double" for x in names)).toArrow()
    x = np.array(sorted(zip(*(rows.column(name).to_pylist() for name in names)))).reshape(-1, len(names))
    field.link = _logistic(x[:, :-1], x[:, -1])
    whole = {row.label: row["count"] for row in common.known_labels(labels, label, held_out).groupBy("label").count().collect()}
    # each class is sampled at its own rate, which shifts the log odds of all documents alike
    rate = [min(whole[k], fit_rows) / whole[k] for k in (0, 1)]
    field.link[0] += np.log(rate[0] / rate[1])
    return field


def with_score(docs: DataFrame, field: Field | None, name: str = "toxicity") -> DataFrame:
    """The rows with one more column, a struct: score, and the offending spans in code points."""
    kind = "struct<score: double, spans: array<struct<begin: bigint, end: bigint>>>"
    if field is None:
        return docs.withColumn(name, F.struct(F.lit(0.0).alias("score"), F.array().cast("array<struct<begin: bigint, end: bigint>>").alias("spans")))
    sent = docs.sparkSession.sparkContext.broadcast(field)
    key = uuid.uuid4().hex
    inner = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))])

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            texts, found = batch.column("text").to_pylist(), []
            for text, (m, value) in zip(texts, _scorer(key, sent).batch(texts)):
                spans = Scorer.offsets(text, m) if len(m) and m.max() >= 0.5 else []
                found.append({"score": value, "spans": [{"begin": low, "end": high} for low, high in spans]})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, inner)], names=[*batch.schema.names, name])

    return common.mapped(docs, score, docs.withColumn(name, F.lit(None).cast(kind)).schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether it is held out, its score, the decision, and its offending spans."""
    held_out = common.fold(4, 2)
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels, held_out))
    return scored.select(
        "doc_id", held_out.alias("held_out"), F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= THRESHOLD).cast("int").alias("predicted"), F.col("toxicity.spans").alias("spans"),
    )


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below the threshold, with their own columns."""
    name = common.free_name(docs, "toxicity")
    scored = with_score(docs, fit(docs, labels, common.fold(4, 2)), name)
    return scored.where(F.col(name)["score"] < THRESHOLD).select(*docs.columns)
