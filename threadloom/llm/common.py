"""What the operators share: input tables, stored intermediate tables, label folds and batches of texts."""

from __future__ import annotations

import pickle
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.session import ensure_checkpoint_dir

#: Rows of a batch that a task works on at a time; bounds the memory that intermediate arrays take.
SLICE_ROWS = 256
#: Bytes of text in such a slice; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder that all executors share; removed when the application ends."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stored(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """The table, written once to the shared folder and read from there: no executor's loss repeats the work above it."""
    folder = shared_folder(df.sparkSession)
    df.write.option("compression", compression).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package's code to the Python workers, once an application; nothing to do if it came as an archive."""
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if context.applicationId in _SHIPPED or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="threadloom-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))  # Spark's own file server hands it to the executors
    _SHIPPED.add(context.applicationId)


def mapped(df: DataFrame, function: Callable, schema) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def in_task(spark: SparkSession, function: Callable, *given):
    """What the function returns for the given values, worked out in a Python worker.

    For small dense algebra: Spark holds a worker's matrix library to the cores of its task, while in the driver, next to the
    virtual machine, its threads may wait for each other without end. Values and result must have a bounded size.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _ in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(function(*given))], pa.binary())], names=["result"])

    return pickle.loads(mapped(spark.range(0, 1, 1, 1), run, "result binary").first()["result"])


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one made from it that no column has."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(divisor: int, remainder: int, doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves this remainder; a missing id counts as not."""
    rest = F.crc32(F.col(doc_id).cast("string").cast("binary")) % divisor
    return F.coalesce(rest == remainder, F.lit(False))


def slices(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most SLICE_ROWS rows and, but for single long texts, SLICE_BYTES of text."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
        start, size = 0, 0
        for row, length in enumerate(lengths):
            if row > start and (row - start >= SLICE_ROWS or size + length > SLICE_BYTES):
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length
        if len(lengths) > start:
            yield batch.slice(start)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [column if isinstance(column, pa.Array) else pa.array(column, kind.type) for column, kind in zip(columns, schema)],
        schema=schema,
    )


def known_labels(labels: DataFrame, label: str, held_out: Column) -> DataFrame:
    """Labelled ids outside the held-out fold; a repeated id counts once, with its largest label."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )


def sampled_labels(labels: DataFrame, label: str, held_out: Column, rows: int) -> DataFrame:
    """Per class, at most ``rows`` labelled ids outside the held-out fold, chosen by a hash of the id.

    A repeated id counts once, with its largest label. The result has at most 2 * rows rows, so it may be broadcast.
    """
    known = known_labels(labels, label, held_out)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return known.where("label = 0").orderBy(*order).limit(rows).unionByName(
        known.where("label = 1").orderBy(*order).limit(rows)
    )
