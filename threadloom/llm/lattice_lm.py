"""Language-model scores from a subword lattice: the marginal probability of a text over all its segmentations.

The pieces of an existing vocabulary are the model's alphabet. A text is a sequence of words, each with a start mark, and an end;
every way to write it as pieces is a path in the lattice, its probability the product of the pieces' probabilities, and
the text's probability the sum over all paths. No piece spans a word's start, so the lattice falls apart at words, and a
forward recursion in log space gives each distinct word's marginal once, whatever number of texts it is in.

One set of probabilities for all languages would choose the language anew at each piece. So there are CLASSES sets, and a text's
probability is the sum over the classes as well. The classes are a mixture model of all training documents, whose words are hashed
and counted once; a bounded sample only gives the points to start from. Then every training document counts for its likeliest class. The vocabulary's own order gives the first
probabilities; the words of all training documents, with their counts, improve them by expectation-maximisation: forward and
backward recursions give each piece's expected number of uses.

Words are counted by partial aggregation and a shuffle. The HOT most frequent words, a bounded table, are sent to all tasks; the
others are joined to the documents' remaining words by a shuffle on the word.

Defined results: a null or empty text is its end only; rows with the same id are scored each on their own; without training
documents the counts are 0 and the vocabulary's own weights score the texts.
"""

from __future__ import annotations

import copy
import functools
import uuid
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm import common, subwords

ROUNDS = 3
CLASSES = 6
#: Training documents that give the classes' starting points, and the hashed words that stand for a document.
SAMPLE_DOCS = 1000
BUCKETS = 4096
#: Rounds over all training documents that the classes take at most, and the share of the likelihood that a further one must gain.
CLASS_ROUNDS = 10
CLASS_GAIN = 1e-5
#: Most frequent words that every task holds (about 150 bytes each).
HOT = 200_000
#: Distinct words that a task counts before it passes them on.
COUNTED = 300_000
#: Bytes of words that one recursion handles side by side.
LATTICE_BYTES = 200_000
#: Words of more bytes are handled one by one.
LONG_WORD = 400
#: Uses that every piece has besides the expected ones, so that none becomes impossible.
PRIOR = 0.01
_BASE = np.uint64(1099511628211)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BITS = 20
_LOG10 = float(np.log(10.0))
#: Shares of a document in a class below this are lost in the rounding of the sums that they would join.
_NEGLIGIBLE = 1e-18
#: Words that a task gathers for one recursion.
TOGETHER = 20_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()  # of bytes: A-Z, and at space and \t..\r


class Lattice:
    """Recursions over words, for several sets of probabilities side by side.

    ``logs`` are the pieces' natural-log probabilities, a row for each set. What a word's arcs are does not depend on them.
    """

    def __init__(self, pieces: list[bytes], logs: np.ndarray):
        self.logs = np.ascontiguousarray(np.atleast_2d(logs).T)  # [piece, set]
        self.longest = max(map(len, pieces))
        self.keys, self.numbers = np.zeros(1 << _BITS, np.uint64), np.full(1 << _BITS, len(pieces), np.int32)
        hashes = np.zeros(len(pieces), np.uint64)
        by_length: dict[int, list[int]] = {}
        for number, piece in enumerate(pieces):
            by_length.setdefault(len(piece), []).append(number)
        for length, members in by_length.items():
            raw = np.frombuffer(b"".join(pieces[k] for k in members), np.uint8).reshape(-1, length).astype(np.uint64)
            value = np.zeros(len(members), np.uint64)
            for k in range(length):
                value = value * _BASE + raw[:, k] + np.uint64(1)
            hashes[members] = value
        for number, (value, at) in enumerate(zip(hashes.tolist(), self._slot(hashes).tolist())):
            for probe in range(1 << _BITS):
                slot = (at + probe) & ((1 << _BITS) - 1)
                if self.numbers[slot] == len(pieces):
                    self.keys[slot], self.numbers[slot] = value, number
                    break

    def with_logs(self, logs: np.ndarray) -> Lattice:
        """The same pieces with other probabilities."""
        other = copy.copy(self)
        other.logs = np.ascontiguousarray(np.atleast_2d(logs).T)
        return other

    @staticmethod
    def _slot(hashes):
        return ((hashes * _MIX) >> np.uint64(64 - _BITS)).astype(np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The pieces' numbers, or the number of pieces for what is none."""
        none, slot = len(self.logs), self._slot(hashes)
        found = self.numbers[slot]
        pending = np.flatnonzero((found != none) & (self.keys[slot] != hashes))  # the slot is another's: look on
        while len(pending):
            slot[pending] = (slot[pending] + 1) & ((1 << _BITS) - 1)
            found[pending] = self.numbers[slot[pending]]
            pending = pending[(found[pending] != none) & (self.keys[slot[pending]] != hashes[pending])]
        return found

    def _arcs(self, words: list[bytes]):
        """For words of ascending length: their lengths, the place of each one's start, and by length of a piece the
        places where such pieces end, the pieces, the words, and where those that end after t bytes begin in these arrays.

        A word has a place before each byte and one after the last.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        owner = np.repeat(np.arange(len(words)), lengths)
        begins = np.cumsum(lengths) - lengths
        raw = np.frombuffer(b"".join(subwords.START + word for word in words), np.uint8).astype(np.uint64) + np.uint64(1)
        offset = np.arange(len(raw)) - begins[owner]
        arcs, at, value = [], np.arange(len(raw)), np.zeros(len(raw) + 1, np.uint64)
        steps = np.arange(int(lengths[-1]) + 2)
        for length in range(1, min(self.longest, int(lengths[-1])) + 1):
            at = at[offset[at] >= length - 1]
            fresh = np.zeros(len(raw) + 1, np.uint64)
            fresh[at + 1] = value[at] * _BASE + raw[at]  # value[p] is the hash of length - 1 bytes that end before p
            value = fresh
            piece = self._find(value[at + 1])
            some = np.flatnonzero(piece < len(self.logs))
            ends, piece = at[some], piece[some]
            reach = offset[ends] + 1
            if lengths[-1] <= LONG_WORD:
                order = np.argsort(reach.astype(np.uint16), kind="stable")
                ends, piece, reach = ends[order], piece[order], reach[order]
                bounds = np.searchsorted(reach, steps)
            else:
                bounds = None
            arcs.append((ends + owner[ends] + 1, piece, owner[ends], bounds))
        return lengths, begins + np.arange(len(words)), arcs

    def _sums(self, values: np.ndarray, arcs: list, lengths: np.ndarray, first: np.ndarray, t: int, step: int) -> None:
        """Sets values at the places after t bytes of all words that go on from there (step -1), or reach there (step 1):
        the log of the summed weight of the arcs that begin, or end, there."""
        low = int(np.searchsorted(lengths, t, side="left" if step > 0 else "right"))
        best = np.full((len(lengths) - low, values.shape[1]), -np.inf)
        found = []
        for k, (ends, piece, word, bounds) in enumerate(arcs):
            last = t if step > 0 else t + k + 1  # bytes before the arcs' ends
            if last < len(bounds) - 1 and bounds[last] < bounds[last + 1]:
                some = slice(bounds[last], bounds[last + 1])
                there = ends[some] - k - 1 if step > 0 else ends[some]
                weight, mine = values[there] + self.logs[piece[some]], word[some] - low
                best[mine] = np.maximum(best[mine], weight)
                found.append((mine, weight))
        most = np.where(best == -np.inf, 0.0, best)
        total = np.zeros_like(best)
        for mine, weight in found:
            total[mine] += np.exp(weight - most[mine])
        with np.errstate(divide="ignore"):
            values[first[low:] + t] = most + np.log(total)

    def _along(self, values: np.ndarray, table: np.ndarray, step: int) -> None:
        """The recursion of one long word, by position; all lengths of a piece side by side. step -1: from the right."""
        logs = np.concatenate([self.logs, np.full((1, self.logs.shape[1]), -np.inf)])
        length = table.shape[1]
        lengths = np.arange(len(table))
        for t in range(1, length + 1) if step > 0 else range(length - 1, -1, -1):
            if step > 0:
                reach = lengths[: min(t, len(table))]
                x = values[t - 1 - reach] + logs[table[reach, t - 1]]
            else:
                reach = lengths[: min(length - t, len(table))]
                x = values[t + 1 + reach] + logs[table[reach, t + reach]]
            most = x.max(0)
            with np.errstate(divide="ignore", invalid="ignore"):
                values[t] = np.where(most == -np.inf, -np.inf, most + np.log(np.exp(x - most).sum(0)))

    def _tables(self, lengths: np.ndarray, first: np.ndarray, arcs: list) -> Iterator[tuple[int, np.ndarray]]:
        """For long words: each one's start, and its pieces by length and end."""
        for start, length in zip(first.tolist(), lengths.tolist()):
            table = np.full((len(arcs), length), len(self.logs), np.int64)
            for k, (ends, piece, _, _) in enumerate(arcs):
                low, high = np.searchsorted(ends, [start, start + length + 1])
                table[k, ends[low:high] - start - 1] = piece[low:high]
            yield start, table

    def forward(self, words: list[bytes]):
        """Log of the summed weight of all paths up to each place [place, set]; a word's first place is its own start."""
        lengths, first, arcs = self._arcs(words)
        alpha = np.full((int(lengths.sum()) + len(words), self.logs.shape[1]), -np.inf)
        alpha[first] = 0.0
        if lengths[-1] > LONG_WORD:
            for start, table in self._tables(lengths, first, arcs):
                self._along(alpha[start : start + table.shape[1] + 1], table, 1)
        else:
            for t in range(1, int(lengths[-1]) + 1):
                self._sums(alpha, arcs, lengths, first, t, 1)
        return alpha, arcs, lengths, first

    def batches(self, words: list[bytes]) -> Iterator[np.ndarray]:
        """Numbers of words of like length, so many that a recursion handles them side by side."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        ends = np.cumsum(lengths[order] + 1)
        low = 0
        while low < len(order):
            done = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, done + LATTICE_BYTES, side="right")))
            long = int(np.searchsorted(lengths[order], LONG_WORD, side="left"))
            high = min(high, long) if low < long else high  # long words are handled apart
            yield order[low:high]
            low = high

    def scores(self, words: list[bytes]) -> np.ndarray:
        """Natural logs of the words' marginal probabilities [word, set]."""
        result = np.zeros((len(words), self.logs.shape[1]))
        for chosen in self.batches(words):
            alpha, _, lengths, first = self.forward([words[k] for k in chosen])
            result[chosen] = alpha[first + lengths]
        return result

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """By piece, the expected number of uses in words that occur so often, with the first set of probabilities."""
        uses = np.zeros(len(self.logs))
        for chosen in self.batches(words):
            alpha, arcs, lengths, first = self.forward([words[k] for k in chosen])
            beta = np.full_like(alpha, -np.inf)
            beta[first + lengths] = 0.0
            if lengths[-1] > LONG_WORD:
                for start, table in self._tables(lengths, first, arcs):
                    self._along(beta[start : start + table.shape[1] + 1], table, -1)
            else:
                for t in range(int(lengths[-1]) - 1, -1, -1):
                    self._sums(beta, arcs, lengths, first, t, -1)
            a, b, logs = alpha[:, 0], beta[:, 0], self.logs[:, 0]
            whole = a[first + lengths]
            for k, (ends, piece, mine, _) in enumerate(arcs):
                share = a[ends - k - 1] + logs[piece] + b[ends] - whole[mine]
                uses += np.bincount(piece, np.exp(share) * counts[chosen][mine], len(uses))
        return uses


def _buckets(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % BUCKETS


def mixture(counts: np.ndarray, classes: int, starts: int = 8, rounds: int = 15) -> np.ndarray:
    """Log weights [class, bucket], the last column for the class itself, of a mixture of word distributions.

    Expectation-maximisation from several starts, each with documents that are drawn far from each other; the start that ends with the
    highest likelihood counts.
    """
    found = np.full((classes, BUCKETS + 1), -np.log(BUCKETS))
    found[:, -1] = -np.log(classes)
    sizes = counts.sum(1)
    counts, sizes = counts[sizes > 0].astype(np.float32), sizes[sizes > 0].astype(np.float32)
    if len(counts) < classes:
        return found
    unit = np.sqrt(counts / sizes[:, None])
    near = unit @ unit.T
    long = np.flatnonzero(sizes >= np.median(sizes))
    best = -np.inf
    for start in range(starts):
        draw = np.random.default_rng(start)
        chosen = [int(draw.choice(long))]
        while len(chosen) < classes:
            far = np.maximum(1 - near[np.ix_(long, chosen)].max(1), 1e-6) ** 2.0
            chosen.append(int(draw.choice(long, p=far / far.sum())))
        share = np.eye(classes, dtype=np.float32)[near[:, chosen].argmax(1)]
        for _ in range(rounds):
            words = share.T @ counts + 0.1
            model = np.column_stack([np.log(words / words.sum(1, keepdims=True)), np.log((share.sum(0) + 1) / (len(share) + classes))])
            weight = counts @ model[:, :-1].T.astype(np.float32) + model[:, -1]
            most = weight.max(1, keepdims=True)
            share = np.exp(weight - most)
            total = share.sum(1, keepdims=True)
            share = (share / total).astype(np.float32)
        likelihood = float((most + np.log(total)).sum())
        if likelihood > best:
            best, found = likelihood, model
    return found


def _hashed(docs: DataFrame, held_out: Column) -> DataFrame:
    """The distinct buckets of each training document's words, two bytes each, how many words each has, and a mark to draw by; stored."""
    schema = pa.schema([("mark", pa.int64()), ("buckets", pa.binary()), ("times", pa.binary())])

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            found = [np.bincount(_buckets(words_of(text)), minlength=BUCKETS) for text in batch.column("text").to_pylist()]
            used = list(map(np.flatnonzero, found))
            buckets = [some.astype(np.uint16).tobytes() for some in used]
            yield common.batch_of(schema, [batch.column("mark"), buckets, [x[some].astype(np.uint32).tobytes() for x, some in zip(found, used)]])

    mark = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64("text"))
    marked = docs.where(~held_out & F.col("text").isNotNull()).select(mark.alias("mark"), "text")
    return common.stored(common.mapped(marked, hashed, "mark bigint, buckets binary, times binary").where(F.octet_length("buckets") > 0))


def _start(hashed: DataFrame, classes: int) -> np.ndarray:
    chosen = hashed.select("mark").distinct().orderBy("mark").limit(SAMPLE_DOCS).agg(F.max("mark").alias("mark")).first().mark
    if chosen is None:
        return mixture(np.zeros((0, BUCKETS)), classes)
    schema = pa.schema([("mark", pa.int64()), ("counts", pa.binary())])

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "buckets"):
            counts = np.zeros((batch.num_rows, BUCKETS), np.uint32)
            for row, raw, times in zip(counts, batch.column("buckets").to_pylist(), batch.column("times").to_pylist()):
                row[np.frombuffer(raw, np.uint16)] = np.frombuffer(times, np.uint32)
            yield common.batch_of(schema, [batch.column("mark"), [row.tobytes() for row in counts]])

    sample = common.mapped(hashed.where(F.col("mark") <= chosen), counted, "mark bigint, counts binary")
    rows = sample.orderBy("mark", "counts").limit(SAMPLE_DOCS).toArrow()
    return mixture(np.frombuffer(b"".join(rows.column("counts").to_pylist()), np.uint32).reshape(-1, BUCKETS), classes)


def _shares(model: np.ndarray, buckets: np.ndarray, times: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document's probabilities of the classes, and its log-likelihood; ``buckets`` are those of all documents' words,
    with so many words each, and a document has ``lengths`` of them."""
    begins = np.cumsum(lengths) - lengths
    weight = np.stack([np.add.reduceat(mine[buckets] * times, begins) for mine in model], 1) + model[:, -1]
    most = weight.max(1, keepdims=True)
    share = np.exp(weight - most)
    total = share.sum(1, keepdims=True)
    return share / total, (most + np.log(total)).ravel()


def _classes(docs: DataFrame, held_out: Column, classes: int) -> np.ndarray:
    """The mixture's log weights (see ``mixture``), by expectation-maximisation over all training documents."""
    hashed = _hashed(docs, held_out)
    model = _start(hashed, classes)
    schema = pa.schema([("place", pa.int64()), ("uses", pa.float64())])
    wide = BUCKETS + 1  # expected uses by bucket and, last, documents; after the last class the log-likelihood
    before = -np.inf
    for _ in range(CLASS_ROUNDS):
        sent = docs.sparkSession.sparkContext.broadcast(model)

        def uses(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            sums, whole = np.zeros((classes, wide)), 0.0
            for batch in common.slices(batches, "buckets"):
                raw = batch.column("buckets").to_pylist()
                buckets = np.frombuffer(b"".join(raw), np.uint16).astype(np.intp)
                lengths = np.fromiter(map(len, raw), np.int64, len(raw)) // 2
                times = np.frombuffer(b"".join(batch.column("times").to_pylist()), np.uint32).astype(float)
                share, likelihood = _shares(sent.value, buckets, times, lengths)
                whole += likelihood.sum()
                sums[:, -1] += share.sum(0)
                for k in range(classes):
                    some = share[:, k] > _NEGLIGIBLE
                    if some.any():
                        mine = slice(None) if some.all() else np.repeat(some, lengths)
                        sums[k, :-1] += np.bincount(buckets[mine], np.repeat(share[some, k], lengths[some]) * times[mine], BUCKETS)
            found = np.append(sums.ravel(), whole)
            some = np.flatnonzero(found)
            yield common.batch_of(schema, [some, found[some]])

        rows = common.mapped(hashed.select("buckets", "times"), uses, "place bigint, uses double")
        expected = np.zeros(classes * wide + 1)  # at most a number for each bucket and class
        for row in rows.groupBy("place").agg(F.sum("uses").alias("uses")).collect():
            expected[row.place] = row.uses
        sent.unpersist()
        likelihood, expected = expected[-1], expected[:-1].reshape(classes, wide)
        if not expected.any():  # no training documents
            break
        words, members = expected[:, :-1] + 0.1, expected[:, -1]
        model = np.column_stack([np.log(words / words.sum(1, keepdims=True)), np.log((members + 1) / (members.sum() + classes))])
        if likelihood - before <= CLASS_GAIN * abs(likelihood):
            break
        before = likelihood
    return model


def _word_counts(docs: DataFrame, held_out: Column, classes: np.ndarray) -> DataFrame:
    """word and its counts n_0, n_1... in training documents by class (0 for words of others only), stored.

    The word ``START`` counts documents.
    """
    n = len(classes)
    schema = pa.schema([("word", pa.binary()), *((f"n_{k}", pa.int64()) for k in range(n))])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt: list[dict[bytes, int]] = [{} for _ in range(n)]
        other: set[bytes] = set()

        def flush() -> pa.RecordBatch:
            words = list(other.union(*learnt))
            columns = [words, *(list(map(mine.get, words, repeat(0))) for mine in learnt)]
            for mine in (*learnt, other):
                mine.clear()
            return common.batch_of(schema, columns)

        for batch in common.slices(batches):
            fresh: list[list[bytes]] = [[] for _ in range(n)]
            for text, out in zip(batch.column("text").to_pylist(), batch.column("out").to_pylist()):
                words = words_of(text)
                if out:
                    other.update(words)
                else:
                    mine = fresh[int((classes[:, _buckets(words)].sum(1) + classes[:, -1]).argmax())]
                    mine += words
                    mine.append(subwords.START)
            for mine, words in zip(learnt, fresh):  # counted by themselves first: a small table is near at hand
                get = mine.get
                for word, count in Counter(words).items():
                    mine[word] = get(word, 0) + count
            if sum(map(len, learnt)) + len(other) > COUNTED:
                yield flush()
        yield flush()

    marked = docs.select("text", held_out.alias("out"))
    kinds = ", ".join(["word binary", *(f"n_{k} bigint" for k in range(n))])
    counted = common.mapped(marked, count, kinds).groupBy("word")
    return common.stored(counted.agg(*(F.sum(f"n_{k}").alias(f"n_{k}") for k in range(n))))


@dataclass
class Model:
    """By class: the pieces' natural-log probabilities; base-10 logs of the end's and of the class's."""

    path: str
    logs: np.ndarray
    end: np.ndarray
    prior: np.ndarray


_LATTICES: dict[str, Lattice] = {}


def _lattice(model: Model) -> Lattice:
    """The model's classes side by side. The pieces' table is built once in a worker."""
    if model.path not in _LATTICES:
        _LATTICES.clear()
        _LATTICES[model.path] = Lattice(subwords.load(model.path)[0], model.logs)
    return _LATTICES[model.path].with_logs(model.logs)


def fit(counts: DataFrame, documents: np.ndarray, path: str, rounds: int = ROUNDS) -> Model:
    """The classes' probabilities from word counts; ``documents``: how many each class has."""
    pieces, logs = subwords.load(path)
    n = len(documents)
    learnt = counts.where(F.col("word") != F.lit(subwords.START)).where(" or ".join(f"n_{k} > 0" for k in range(n)))
    schema = pa.schema([("place", pa.int64()), ("uses", pa.float64())])
    model = Model(path, np.tile(logs, (n, 1)), np.zeros(n), np.log10((documents + 0.5) / (documents + 0.5).sum()))
    total = np.ones(n)
    for _ in range(rounds if documents.any() else 0):
        sent = counts.sparkSession.sparkContext.broadcast(model)

        def uses(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            sums, lattice = np.zeros((n, len(pieces))), _lattice(sent.value)
            each = [lattice.with_logs(logs) for logs in sent.value.logs]  # most words are of one class only
            held: list[tuple[list[bytes], list[np.ndarray]]] = [([], []) for _ in range(n)]

            def add(k: int) -> None:
                words, times = held[k]
                if words:
                    sums[k] += each[k].expected(words, np.concatenate(times).astype(float))
                held[k] = ([], [])

            for batch in batches:
                words = np.array(batch.column("word").to_pylist(), object)
                for k in range(n):
                    times = batch.column(f"n_{k}").to_numpy()
                    some = np.flatnonzero(times)
                    held[k][0].extend(words[some].tolist())
                    held[k][1].append(times[some])
                    if len(held[k][0]) >= TOGETHER:
                        add(k)
            for k in range(n):
                add(k)
            some = np.flatnonzero(sums.ravel())
            yield common.batch_of(schema, [some, sums.ravel()[some]])

        rows = common.mapped(learnt, uses, "place bigint, uses double").groupBy("place").agg(F.sum("uses").alias("uses")).collect()
        expected = np.zeros(n * len(pieces))  # at most a number for each piece and class
        for row in rows:
            expected[row.place] = row.uses
        expected = expected.reshape(n, -1) + PRIOR
        total = expected.sum(1)
        model.logs = np.log(expected / (total + documents + 0.5)[:, None])
    if not documents.any():
        model.logs = model.logs + np.log(total / (total + 0.5))[:, None]
    model.end = np.log10((documents + 0.5) / (total + documents + 0.5))
    return model


def _hottest(counts: DataFrame, most: int) -> int:
    """The least count of at most ``most`` words."""
    by_size = F.floor(F.log2(F.col("n")) * 8).cast("int").alias("size")  # some 300 sizes, whatever the table
    rows = counts.where("n > 0").groupBy(by_size).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect()
    held, least = 0, 1 << 62
    for row in sorted(rows, key=lambda row: -row.least):
        held += row.words
        if held > most:
            break
        least = row.least
    return least


def scored(docs: DataFrame, held_out: Column, path: str | None = None, hot: int = HOT, classes: int = CLASSES) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    path = path or subwords.default_vocabulary()
    context = docs.sparkSession.sparkContext
    by_class = [f"n_{k}" for k in range(classes)]
    counts = _word_counts(docs, held_out, _classes(docs, held_out, classes))
    is_end = F.col("word") == F.lit(subwords.START)
    first = counts.where(is_end).first()
    documents = np.array([first[name] for name in by_class] if first else [0] * classes, float)
    ends = int(documents.sum())
    c = functools.reduce(Column.__add__, map(F.col, by_class))
    whole = counts.where(~is_end).agg(F.sum(c).alias("n"), F.sum((c > 0).cast("long")).alias("v")).first()
    tokens, distinct = (whole.n or 0) + ends, (whole.v or 0) + (ends > 0)
    below = tokens + 0.5 * (distinct + 1)
    model = fit(counts, documents, path)
    sent = context.broadcast(model)
    weights = [f"w_{k}" for k in range(classes)]
    rated_schema = pa.schema([("word", pa.binary()), ("n", pa.int64()), *((name, pa.float64()) for name in weights)])

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(sent.value)
        for batch in batches:
            if batch.num_rows:
                found = lattice.scores(batch.column("word").to_pylist()) / _LOG10
                yield common.batch_of(rated_schema, [batch.column("word"), batch.column("n"), *np.ascontiguousarray(found.T)])

    kinds = ", ".join(f"{name} double" for name in weights)
    narrow = counts.where(~is_end).select("word", c.alias("n"))
    rated = common.stored(common.mapped(narrow, rate, f"word binary, n bigint, {kinds}"))
    least = _hottest(rated, hot)
    top = rated.where(F.col("n") >= least).toArrow()  # at most ``hot`` rows
    held = context.broadcast(
        (top.column("word").to_pylist(), top.column("n").to_numpy(), np.stack([top.column(name).to_numpy() for name in weights]))
    )
    hot_key = uuid.uuid4().hex
    schema = pa.schema(
        [("row", pa.binary()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("word", pa.binary()), ("times", pa.int64()),
         ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), *((f"s_{k}", pa.float64()) for k in range(classes))]
    )
    end_known, end_base = int(ends > 0), float(np.log10((ends + 0.5) / below))

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, times, scores = _hot(hot_key, held)
        base_of = np.log10((times + 0.5) / below)
        part, row = TaskContext.get().partitionId(), 0
        for batch in common.slices(batches):
            out: list[tuple] = []
            names, words_left, counts_left = [], [], []
            for doc, mark, text in zip(*(batch.column(name).to_pylist() for name in ("doc_id", "out", "text"))):
                name = part.to_bytes(4, "big") + row.to_bytes(6, "big")
                row += 1
                words = Counter(words_of(text))
                uses = np.fromiter(words.values(), np.int64, len(words))
                at = np.fromiter(map(place.get, words, repeat(-1)), np.int64, len(words))
                hot = at >= 0
                known, often = at[hot], uses[hot]
                sums = (scores[:, known] @ often + sent.value.end).tolist()
                base = float(base_of[known] @ often) + end_base
                # this row's key is no word, so the join below gives it nothing
                out.append((name, doc, mark, subwords.START + name, 1, int(uses.sum()) + 1, int(often.sum()) + end_known, base, *sums))
                if len(known) < len(words):
                    cold = (~hot).tolist()
                    words_left += compress(words, cold)
                    counts_left += compress(words.values(), cold)
                    names += [name] * (len(words) - len(known))
            yield common.batch_of(schema, list(map(list, zip(*out))))
            if names:  # the documents' other words, with nothing of the documents but their rows' names
                known = {"row": names, "word": words_left, "times": counts_left}
                yield common.batch_of(schema, [known.get(kind.name, pa.nulls(len(names), kind.type)) for kind in schema])

    texts = docs.select(F.col("doc_id").cast("bigint"), held_out.alias("out"), "text")
    rows = common.mapped(
        texts, split,
        "row binary, doc_id bigint, held_out boolean, word binary, times bigint, n_tokens bigint, n_known bigint, base double, "
        + ", ".join(f"s_{k} double" for k in range(classes)),
    )
    cold = rated.where(F.col("n") < least).withColumnRenamed("n", "c")
    times, c = F.col("times"), F.col("c")
    summed = rows.join(cold, "word", "left").groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("n_known", F.when(c > 0, times).otherwise(0))).alias("n_known"),
        F.sum(F.coalesce("base", times * F.log10((c + 0.5) / below))).alias("base_score"),
        *(F.sum(F.coalesce(f"s_{k}", times * F.col(f"w_{k}"))).alias(f"s_{k}") for k in range(classes)),
    )
    paths = [F.col(f"s_{k}") + float(model.prior[k]) for k in range(classes)]
    best = F.greatest(*paths) if classes > 1 else paths[0]
    score = best + F.log10(functools.reduce(Column.__add__, [F.pow(F.lit(10.0), path - best) for path in paths]))
    return summed.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", score.alias("score")
    )


_HELD: dict[str, tuple] = {}


def _hot(key: str, held) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    if key not in _HELD:
        _HELD.clear()
        words, n_counts, weights = held.value
        _HELD[key] = ({word: k for k, word in enumerate(words)}, n_counts, weights)
    return _HELD[key]


def report(docs: DataFrame) -> DataFrame:
    return scored(docs, common.fold(5, 1))
