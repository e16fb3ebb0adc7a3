"""Quality rules from repetition coverage, measured with rolling hashes of several n-gram lengths.

Every n-gram of words gets a 64-bit rolling hash, H(n, i) = H(n-1, i) * P + w(i+n-1), computed for all positions at once
and for one length after the other. Characters inside n-grams that a text holds at least twice, and inside lines that
equal an earlier line, are measured against all characters in words. One pass over the texts; no shuffle.

Defined results: a null or empty text has no words and is not kept; other columns pass through untouched; repeated rows
are judged each on their own; a table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import common

_SYMBOLS = b"#*$%&|<>"
_BASE = np.uint64(0x9E3779B97F4A7C15)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("dup_line_chars", "symbols_per_word", "adjacent_repeats")


@dataclass(frozen=True)
class Limits:
    """Shares above which a text is rejected. ``coverage``: by n-gram length, of characters in repeated n-grams, the
    first copy not counted; shorter n-grams repeat by chance in long texts, so they have the higher limits."""

    min_words: int = 20
    repeat_words_pct: int = 30
    window: int = 8
    coverage: dict[int, float] = field(
        default_factory=lambda: {5: 0.35, 6: 0.32, 7: 0.30, 8: 0.28, 9: 0.26, 10: 0.25}
    )
    dup_line_chars: float = 0.30
    symbols_per_word: float = 0.10
    adjacent_repeats: float = 0.20


def _spans(starts: np.ndarray, width: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a window of ``width`` that begins at one of ``starts``."""
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:-1]) > 0


def _repeats(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hash: whether it occurs at least twice, and whether it occurred before."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    repeated, later = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    repeated[order[1:]] = later[order[1:]] = same
    repeated[order[:-1]] |= same
    return repeated, later


def measure(text: str | None, limits: Limits = Limits()) -> tuple[dict[str, int], dict[str, float], bool, bool]:
    """Counts, shares, whether the base rules fail, and whether the text is kept."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()  # of bytes: at space and \t..\r
    total = len(words)
    lengths = [len(w) for w in words] if len(raw) == len(text) else [len(w.decode("utf-8", "replace")) for w in words]
    chars = np.array(lengths, np.int64)
    word_chars = int(chars.sum())
    lines = [line for line in text.split("\n") if line.encode("utf-8", "replace").split()]
    fresh: set[str] = set()
    dup_chars = 0
    for line in lines:
        if line in fresh:
            dup_chars += sum(len(w.decode("utf-8", "replace")) for w in line.encode("utf-8", "replace").split())
        fresh.add(line)
    counts = dict.fromkeys(MEASURES, 0) | {
        "n_words": total,
        "word_chars": word_chars,
        "n_symbols": len(raw) - len(raw.translate(None, _SYMBOLS)),
        "n_dup_lines": len(lines) - len(fresh),
    }
    shares = dict.fromkeys([*RATIOS, *(f"dup_{n}gram_chars" for n in limits.coverage)], 0.0)
    if total:
        ids = np.fromiter(map(hash, words), np.int64, total).view(np.uint64)
        shares["dup_line_chars"] = dup_chars / word_chars
        shares["symbols_per_word"] = counts["n_symbols"] / total
        shares["adjacent_repeats"] = float((ids[1:] == ids[:-1]).sum()) / total
        rolling = ids
        for n in range(2, max(limits.window, *limits.coverage) + 1):
            if total < n:
                break
            rolling = rolling[:-1] * _BASE + ids[n - 1 :]
            if n != limits.window and n not in limits.coverage:
                continue
            repeated, later = _repeats(rolling)
            if not repeated.any():  # then no longer n-gram repeats either
                break
            if n == limits.window:
                counts["n_repeat_words"] = int(_spans(np.flatnonzero(repeated), n, total).sum())
            if n in limits.coverage:
                shares[f"dup_{n}gram_chars"] = float(chars[_spans(np.flatnonzero(later), n, total)].sum()) / word_chars
    base_failed = total < limits.min_words or 100 * counts["n_repeat_words"] > limits.repeat_words_pct * total
    fine = (
        shares["dup_line_chars"] <= limits.dup_line_chars
        and shares["symbols_per_word"] <= limits.symbols_per_word
        and shares["adjacent_repeats"] <= limits.adjacent_repeats
        and all(shares[f"dup_{n}gram_chars"] <= most for n, most in limits.coverage.items())
    )
    return counts, shares, base_failed, fine and not base_failed


def with_rules(docs: DataFrame, limits: Limits = Limits(), name: str = "rules") -> DataFrame:
    """The rows with one more column, a struct: the counts, the shares, ``base_failed`` and ``kept``."""
    ratios = [*RATIOS, *(f"dup_{n}gram_chars" for n in limits.coverage)]
    kinds = [(x, "bigint") for x in MEASURES] + [(x, "double") for x in ratios]
    kinds += [("base_failed", "boolean"), ("kept", "boolean")]
    inner = pa.struct([(x, {"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[kind]) for x, kind in kinds])
    added = F.lit(None).cast(f"struct<{', '.join(f'{x}: {kind}' for x, kind in kinds)}>")

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            found = []
            for text in batch.column("text").to_pylist():
                counts, shares, failed, kept = measure(text, limits)
                found.append(counts | shares | {"base_failed": failed, "kept": kept})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, inner)], names=[*batch.schema.names, name])

    return common.mapped(docs, judge, docs.withColumn(name, added).schema)


def report(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per document its counts, ``base_failed`` and ``kept``."""
    judged = with_rules(docs.select("doc_id", "text"), limits)
    return judged.select("doc_id", *[F.col("rules")[x].alias(x) for x in (*MEASURES, "base_failed", "kept")])


def kept(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows that pass, with their own columns only."""
    name = common.free_name(docs, "rules")
    return with_rules(docs, limits, name).where(F.col(name)["kept"]).select(*docs.columns)
