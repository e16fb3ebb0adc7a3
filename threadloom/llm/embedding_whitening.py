"""Whitening of embeddings from the covariance of distinct vectors, each weighted by how often it occurs.

Entries become whole numbers x = floor(64 c) + 1000000, so equal vectors are equal bytes. Rows are grouped by these bytes; every
sum after that runs over distinct vectors with their counts as weights: exact sums of each dimension, then a weighted
matrix product of what is centred by them, one partial matrix a task. The eigenvectors of the summed matrix whiten
each distinct vector once; a join by the bytes brings the results back to the rows. Vectors with very many copies are
joined in several salted parts, and no copies are ever listed in one place.

Defined results: rows without a vector, or with a null or non-finite entry in it, are left out; vectors of another length form a space of their
own, with sums, components and row count of their own; 64 c saturates at 2^61 on both sides; ``deviation`` is null where it exceeds a
64-bit integer; a component without variance (relative to the largest, within double precision) has ``whitened`` null
and ``explained`` 0 and does not count for ``identity_error``, which is null if none has any; a vector of no entries has no component, hence no row;
repeated ids and missing ids are rows like others; an empty table gives no rows.

What is broadcast or collected: for each vector length d, one d x d matrix and its eigenvectors; at most HOT_VECTORS
vectors that are joined in parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import common

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Copies of one vector that a task joins, at least; more copies are joined in parts.
PART_ROWS = 100_000
#: At most so many vectors can need parts, since the number of copies a part holds grows with the table.
HOT_VECTORS = 10_000
#: Rows of a matrix product at a time.
SLICE = 8192
_FARTHEST = float(1 << 61)


@dataclass(frozen=True)
class Space:
    """All vectors of one length: their number, the whole-number part and the rest of each mean, components and variances."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    components: np.ndarray | None = None
    variances: np.ndarray | None = None
    explained: np.ndarray | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2, which are n^2 times the squared distances from the mean."""
        off = x - self.whole
        farthest = (float(np.abs(off).max(initial=0)) + 1) * self.n
        if farthest * farthest * x.shape[1] < 2.0**62:
            return ((off * self.n - self.rest) ** 2).sum(1).tolist()
        exact = ((off.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(1).tolist()
        return [value if value < 1 << 63 else None for value in exact]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.variances)


def integer_vectors(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The id, and x as the bytes of little-endian 64-bit integers, of all rows with usable vectors."""
    kind = embeddings.schema[id_column].dataType

    def convert(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            present = vectors.is_valid().to_numpy(zero_copy_only=False)
            lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            entries = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)  # null entries become NaN
            row = np.repeat(np.arange(len(lengths)), lengths)
            fine = present & (np.bincount(row[~np.isfinite(entries)], minlength=len(lengths)) == 0)
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.clip(np.floor(entries * SCALE), -_FARTHEST, _FARTHEST)
            x = (np.where(np.isfinite(x), x, 0).astype("<i8") + SHIFT).tobytes()
            ends = 8 * np.cumsum(lengths)
            parts = [x[end - 8 * length : end] for end, length, good in zip(ends, lengths, fine) if good]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(fine)), pa.array(parts, pa.binary())], names=["vec_id", "x"]
            )

    narrow = embeddings.select(F.col(id_column).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    return common.mapped(narrow, convert, f"vec_id {kind.simpleString()}, x binary")


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """x and its number of copies; copies are counted before the shuffle."""
    return vectors.groupBy("x").agg(F.count("*").alias("copies"))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Length, row numbers, matrix of x and copies, for the vectors of each length in the batch."""
    raw = batch.column("x").to_pylist()
    copies = batch.column("copies").to_numpy(zero_copy_only=False)
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 8
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        for at in range(0, len(rows), SLICE):
            part = rows[at : at + SLICE]
            x = np.frombuffer(b"".join(raw[row] for row in part), "<i8").reshape(len(part), size)
            yield size, part, x, copies[part]


def _weights(copies: np.ndarray, counted: bool) -> np.ndarray:
    return copies if counted else np.ones_like(copies)


def means(groups: DataFrame, counted: bool) -> dict[int, Space]:
    """By vector length: the number of fitted vectors and their exact mean."""
    schema = pa.schema([("size", pa.int64()), ("place", pa.int64()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for size, _, x, copies in _by_length(batch):
                weight = _weights(copies, counted)
                if float(np.abs(x).max(initial=0)) * float(weight.sum()) < 2.0**62:
                    total = (weight @ x).astype(object)
                else:
                    total = weight.astype(object) @ x.astype(object)
                kept = found.setdefault(size, [0, np.zeros(size, object)])
                kept[0] += int(weight.sum())
                kept[1] = kept[1] + total
        for size, (n, total) in found.items():
            yield common.batch_of(schema, [[size] * size, list(range(size)), [n] * size, [Decimal(int(value)) for value in total]])

    sums = common.mapped(groups, add, "size bigint, place bigint, n bigint, total decimal(38, 0)")
    rows = sums.groupBy("size", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("size", "place").collect()
    spaces: dict[int, Space] = {}
    for size in sorted({row["size"] for row in rows}):
        own = [row for row in rows if row["size"] == size]
        parts = [divmod(int(row.total), int(row.n)) for row in own]
        spaces[size] = Space(int(own[0].n), np.array([q for q, _ in parts], np.int64), np.array([r for _, r in parts], np.int64))
    return spaces


def covariances(groups: DataFrame, points: Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray, np.ndarray]]]) -> dict[int, np.ndarray]:
    """By vector length: the sum of weight * outer(p, p) over the points, which must be centred.

    ``points`` gives length, points and weights for a batch of groups. Each task multiplies its own; the rows of its matrix
    are added up by Spark.
    """
    schema = pa.schema([("size", pa.int64()), ("place", pa.int64()), ("entries", pa.binary())])

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, p, weight in points(batch):
                product = (p * weight[:, None]).T @ p
                found[size] = found[size] + product if size in found else product
        for size, matrix in found.items():
            yield common.batch_of(schema, [[size] * len(matrix), list(range(len(matrix))), [row.tobytes() for row in matrix]])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in batch.column("entries").to_pylist():
                entries = np.frombuffer(raw, float)
                total = entries if total is None else total + entries
        yield common.batch_of(schema, [[key[0].as_py()], [key[1].as_py()], [total.tobytes()]])

    layout = "size bigint, place bigint, entries binary"
    added = common.mapped(groups, multiply, layout).groupBy("size", "place").applyInArrow(add, layout)
    rows = sorted(added.collect(), key=lambda row: (row["size"], row["place"]))
    return {
        size: np.array([np.frombuffer(row["entries"], float) for row in rows if row["size"] == size])
        for size in sorted({row["size"] for row in rows})
    }


def eigen(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit eigenvectors as rows, their eigenvalues falling, and each one's share of the trace.

    An eigenvector's largest entry is positive. Eigenvalues that rounding alone can make are given as not a number.
    """
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:most]
    values, vectors = values[order], vectors[:, order].T
    peak = np.abs(vectors).argmax(1)
    vectors = vectors * np.where(vectors[np.arange(len(vectors)), peak] < 0, -1.0, 1.0)[:, None]
    trace = float(np.trace(covariance))
    least = max(float(values[0]), 0.0) * len(covariance) * np.finfo(float).eps if len(values) else 0.0
    real = values > least
    explained = np.where(real, values / trace if trace > 0 else 0.0, 0.0)
    return vectors, np.where(real, values, np.nan), explained


def fit(groups: DataFrame, components: int = COMPONENTS, weights: str = "counts") -> dict[int, Space]:
    """The whitening of each vector length, from distinct vectors weighted by their ``counts`` or by ``one``."""
    if weights not in ("counts", "one"):
        raise ValueError(f"unknown weights {weights!r}")
    counted = weights == "counts"
    spaces = means(groups, counted)

    def centred(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for size, _, x, copies in _by_length(batch):
            if size:
                yield size, spaces[size].centred(x), _weights(copies, counted)

    fitted = {}
    for size, product in covariances(groups, centred).items():
        own = spaces[size]
        vectors, values, explained = common.in_task(groups.sparkSession, eigen, product / own.n, components)
        fitted[size] = Space(own.n, own.whole, own.rest, vectors, values, explained)
    return fitted


def whiten(groups: DataFrame, spaces: dict[int, Space]) -> DataFrame:
    """Each distinct vector's deviation and whitened coordinates, null for components without variance."""
    sent = groups.sparkSession.sparkContext.broadcast(spaces)
    schema = pa.schema([("x", pa.binary()), ("copies", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, rows, x, copies in _by_length(batch):
                if not size:
                    continue
                space = sent.value[size]
                values = space.whitened(x)
                ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
                flat = pa.array(values.ravel(), pa.float64(), from_pandas=True)  # NaN becomes null
                yield common.batch_of(schema, [
                    batch.column("x").take(pa.array(rows)), pa.array(copies, pa.int64()), space.deviations(x),
                    pa.ListArray.from_arrays(pa.array(ends), flat),
                ])

    return common.mapped(groups, project, "x binary, copies bigint, deviation bigint, whitened array<double>")


def identity_errors(whitened: DataFrame, spaces: dict[int, Space], weights: str = "counts") -> dict[int, float | None]:
    """By vector length: how far the covariance of the whitened vectors is from the identity, at its worst entry."""
    counted = weights == "counts"

    def points(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        values = batch.column("whitened")
        lengths = values.value_lengths().to_numpy(zero_copy_only=False)
        flat = values.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        for size, rows, _, copies in _by_length(batch):
            wide = len(spaces[size].explained)
            real = int(np.isfinite(spaces[size].variances).sum())
            p = flat[(ends[rows] - wide)[:, None] + np.arange(wide)][:, :real]
            yield size, p, _weights(copies, counted)

    def summed(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for size, p, weight in points(batch):  # a column of ones: the product's first row holds the sums
            yield size, np.column_stack([np.ones(len(p)), p]), weight

    mean = {size: product[0, 1:] / spaces[size].n for size, product in covariances(whitened, summed).items()}

    def centred(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for size, p, weight in points(batch):
            if p.shape[1]:
                yield size, p - mean[size], weight

    products = covariances(whitened, centred)
    return {
        size: float(np.abs(products[size] / space.n - np.eye(len(products[size]))).max()) if size in products else None
        for size, space in spaces.items()
    }


def whitening(
    embeddings: DataFrame,
    components: int = COMPONENTS,
    weights: str = "counts",
    id_column: str = "vec_id",
    vector: str = "embedding",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Per usable row: vec_id, n, deviation, whitened and explained (arrays by component), identity_error."""
    spark = embeddings.sparkSession
    vectors = integer_vectors(embeddings, id_column, vector)
    groups = common.stored(distinct_vectors(vectors))
    spaces = fit(groups, components, weights)
    whitened = common.stored(whiten(groups, spaces))
    errors = identity_errors(whitened, spaces, weights)
    facts = spark.createDataFrame(
        [(size, space.n, space.explained.tolist(), errors[size]) for size, space in spaces.items()],
        "size bigint, n bigint, explained array<double>, identity_error double",
    )  # one row for each vector length
    # Vectors with many copies: each is repeated once for each of its parts, and its rows are dealt to the parts.
    total = groups.agg(F.sum("copies")).first()[0] or 0
    part = max(part_rows, total // HOT_VECTORS)
    parts = F.ceil(F.col("copies") / part).cast("int")
    hot = whitened.where(F.col("copies") > part).select("x", parts.alias("parts"))
    dealt = vectors.join(F.broadcast(hot), "x", "left").select(
        "vec_id", "x", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("parts")), F.lit(0)).cast("int").alias("part")
    )
    answers = whitened.select("x", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "deviation", "whitened")
    joined = dealt.join(answers, ["x", "part"]).withColumn("size", F.expr("octet_length(x) div 8"))
    return joined.join(F.broadcast(facts), "size").select("vec_id", "n", "deviation", "whitened", "explained", "identity_error")


def report(embeddings: DataFrame) -> DataFrame:
    """A row for each usable vector and component."""
    rows = whitening(embeddings)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "of")
    return rows.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation",
        F.col("of.whitened").alias("whitened"), F.col("of.explained").alias("explained"), "identity_error",
    )
