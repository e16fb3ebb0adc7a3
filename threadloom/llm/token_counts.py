"""Token counts by the best segmentation of an existing subword vocabulary, found on a trie of the distinct words.

Words of a batch, sorted, are the leaves of a trie walked depth first: the path to a word is the prefix it shares with the word
before, whose forward scores (best weight up to each position, and the tokens on that way) stay on a stack; only positions
beyond the shared prefix are computed. A word's last position is its terminal and gives its token count, which is stored
and looked up for every occurrence. Of equally good segmentations the one with fewer tokens counts.

Texts are independent: one pass, no shuffle. A null or empty text has no tokens; repeated rows count alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import common, subwords

#: Words whose counts a worker remembers; twice as many for a time.
REMEMBERED = 250_000


class Counter:
    def __init__(self, path: str):
        pieces, logs = subwords.load(path)
        # weight by piece; -inf for what only ends some piece, so that a search from the right knows when to stop
        self.weights = dict.fromkeys((piece[at:] for piece in pieces for at in range(1, len(piece))), -np.inf)
        self.weights.update(zip(pieces, logs.tolist()))
        self.known: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}

    def learn(self, words: Iterable[bytes]) -> None:
        """Store the terminal counts of words not known yet."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older, get = self.known, self.older, self.weights.get
        fresh = set(words).difference(known)
        known.update((word, older[word]) for word in fresh if word in older)
        before, best, tokens = b"", [0.0], [0]  # by position of the current path
        for word in sorted(fresh.difference(known)):
            path = subwords.START + word
            shared = 0
            for a, b in zip(before, path):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], tokens[shared + 1 :]
            for end in range(shared + 1, len(path) + 1):
                top, fewest = -np.inf, 0
                for begin in range(end - 1, -1, -1):
                    weight = get(path[begin:end])
                    if weight is None:
                        break
                    weight += best[begin]
                    if weight > top or (weight == top and tokens[begin] + 1 < fewest):
                        top, fewest = weight, tokens[begin] + 1
                best.append(top)
                tokens.append(fewest)
            known[word] = tokens[-1]
            before = path

    def counts(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """Per text, its words and its tokens."""
        lists = [(text or "").encode("utf-8", "replace").split() for text in texts]
        self.learn(word for words in lists for word in words)
        get = self.known.__getitem__
        return [(len(words), sum(map(get, words))) for words in lists]


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One for each worker and vocabulary."""
    if path not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def with_counts(docs: DataFrame, path: str | None = None, name: str = "counts") -> DataFrame:
    """The rows with one more column, a struct: n_words, n_tokens."""
    vocabulary = path or subwords.default_vocabulary()
    inner = pa.struct([("n_words", pa.int64()), ("n_tokens", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            found = counter(vocabulary).counts(batch.column("text").to_pylist())
            values = pa.array([{"n_words": a, "n_tokens": b} for a, b in found], inner)
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])

    return common.mapped(docs, count, docs.withColumn(name, F.lit(None).cast("struct<n_words: bigint, n_tokens: bigint>")).schema)


def report(docs: DataFrame) -> DataFrame:
    return with_counts(docs.select("doc_id", "text")).select("doc_id", "counts.n_words", "counts.n_tokens")
