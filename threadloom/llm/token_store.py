"""Token ids in files: each document a zstandard frame of its own, under one dictionary for all.

A store is a folder with two Parquet tables, so any file system that Spark writes to can hold it. ``dictionary`` has one row:
the dictionary, trained on serialized id arrays of a bounded sample, and its SHA-256. ``blocks`` has rows of about BLOCK_BYTES:
shard and block number, the id count before the block in its shard, the dictionary's hash, the width of an id, and per
document its id, its number of tokens and the offset of its frame in the payload, which is the last column. A document is read by
taking its frame out of the payload; no other frame is touched. Shards are ranges of doc_id in ascending order.

Defined results: a null or empty text holds the end id only; rows with the same id stay apart, in the order of their texts' hashes; missing
ids come first; an empty table gives a store without blocks.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.llm import common, token_ids

BLOCK_BYTES = 1 << 20
BLOCK_DOCS = 4096
#: The dictionary's size, and the sample it is trained on: whole documents, so many at most and of so many characters together.
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 16 << 20
#: A training set that is too small or too uniform has no dictionary.
_LEAST_SAMPLES = 16
#: Shards whose offsets are sent to all tasks (16 bytes each); more are joined by a shuffle.
BROADCAST_SHARDS = 1_000_000

_BLOCKS = pa.schema(
    [("shard", pa.int64()), ("block", pa.int64()), ("before", pa.int64()), ("n_ids", pa.int64()), ("first_doc", pa.int64()),
     ("last_doc", pa.int64()), ("dictionary_sha256", pa.string()), ("width", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
     ("n_tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("payload", pa.binary())]
)
_BLOCKS_SQL = (
    "shard bigint, block bigint, before bigint, n_ids bigint, first_doc bigint, last_doc bigint, dictionary_sha256 string, "
    "width bigint, doc_ids array<bigint>, n_tokens array<bigint>, offsets array<bigint>, payload binary"
)


def _narrow(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()


def train(docs: DataFrame, vocabulary: str, width: int) -> bytes:
    """The dictionary's content, empty if the documents are too few."""
    marked = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), F.length("text").alias("chars")
    )
    marked = marked.orderBy(F.xxhash64("doc_id"), "doc_id", "mark").limit(SAMPLE_DOCS)
    room, wanted = SAMPLE_CHARS, []
    for row in marked.collect():  # ids and lengths only
        if row.chars <= room:
            room -= row.chars
            wanted.append((row.doc_id, row.mark))
    chosen = docs.sparkSession.createDataFrame(wanted, "doc_id bigint, mark bigint")
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def serialize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            found = token_ids.encoder(vocabulary).ids(batch.column("text").to_pylist())
            yield common.batch_of(schema, [batch.column("doc_id"), [_narrow(ids, width) for ids in found]])

    texts = docs.select(F.col("doc_id").cast("bigint"), "text").withColumn("mark", F.xxhash64("text"))
    sample = texts.join(F.broadcast(chosen.distinct()), ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id", "mark"])
    rows = common.mapped(sample, serialize, "doc_id bigint, ids binary").orderBy("doc_id", "ids").limit(SAMPLE_DOCS)
    samples = [ids for ids in rows.toArrow().column("ids").to_pylist() if len(ids) >= 64]
    if len(samples) < _LEAST_SAMPLES:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples).as_bytes()
    except zstandard.ZstdError:  # the samples hold nothing that is worth a dictionary
        return b""


def write(docs: DataFrame, folder: str, vocabulary: str | None = None) -> None:
    """Encode, compress and store all documents in ascending order of doc_id."""
    path = vocabulary or token_ids.default_vocabulary()
    spark = docs.sparkSession
    width = 2 if token_ids.encoder(path).tokenizer.get_vocab_size() <= 1 << 16 else 4
    content = train(docs, path, width)
    sha = hashlib.sha256(content).hexdigest()
    spark.createDataFrame([(sha, content)], "sha256 string, content binary").write.parquet(f"{folder}/dictionary")

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        given = {"dict_data": zstandard.ZstdCompressionDict(content)} if content else {}
        compressor = zstandard.ZstdCompressor(level=3, write_content_size=True, **given)
        block, before, size, docs_, counts, frames = 0, 0, 0, [], [], []

        def full() -> pa.RecordBatch:
            known = [doc for doc in docs_ if doc is not None]
            ends = [known[0], known[-1]] if known else [None, None]
            offsets = np.cumsum([0, *map(len, frames)]).tolist()
            row = [shard, block, before, sum(counts), *ends, sha, width, docs_, counts, offsets, b"".join(frames)]
            return common.batch_of(_BLOCKS, [[value] for value in row])

        for batch in common.slices(batches):
            found = token_ids.encoder(path).ids(batch.column("text").to_pylist())
            for doc, ids in zip(batch.column("doc_id").to_pylist(), found):
                docs_.append(doc)
                counts.append(len(ids) // 4)
                frames.append(compressor.compress(_narrow(ids, width)))
                size += len(frames[-1])
                if len(docs_) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                    yield full()
                    block, before, size, docs_, counts, frames = block + 1, before + sum(counts), 0, [], [], []
        if docs_:
            yield full()

    narrow = docs.select(F.col("doc_id").cast("bigint"), "text")
    mark = F.xxhash64("text")
    ordered = narrow.repartitionByRange("doc_id", mark).sortWithinPartitions("doc_id", mark)  # rows of one id may take several shards
    common.mapped(ordered, encode, _BLOCKS_SQL).write.option("compression", "none").parquet(f"{folder}/blocks")


def _decoders(spark: SparkSession, folder: str):
    """What gives a decompressor for a dictionary hash, in tasks."""
    known = {row.sha256: bytes(row.content) for row in spark.read.parquet(f"{folder}/dictionary").collect()}  # one row
    sent = spark.sparkContext.broadcast(known)

    def decoder(sha: str) -> zstandard.ZstdDecompressor:
        content = sent.value[sha]  # a block of another dictionary must not be decoded
        if hashlib.sha256(content).hexdigest() != sha:
            raise ValueError(f"dictionary {sha} is damaged")
        return zstandard.ZstdDecompressor(**({"dict_data": zstandard.ZstdCompressionDict(content)} if content else {}))

    return decoder


def _rows(blocks: DataFrame, folder: str, wanted: frozenset[int] | None = None, digest: bool = False) -> DataFrame:
    """doc_id, shard, start in the shard, n_tokens, and the ids as little-endian 32-bit integers or their crc32."""
    decoder = _decoders(blocks.sparkSession, folder)
    kind = ("ids_crc32", pa.int64()) if digest else ("ids", pa.binary())
    schema = pa.schema([("doc_id", pa.int64()), ("shard", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), kind])

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools: dict[str, zstandard.ZstdDecompressor] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names if name != "payload"}
                payload = memoryview(batch.column("payload")[k].as_buffer())
                sha, offsets, at = row["dictionary_sha256"], row["offsets"], row["before"]
                if sha not in tools:
                    tools[sha] = decoder(sha)
                rows = []
                for n, (doc, count) in enumerate(zip(row["doc_ids"], row["n_tokens"])):
                    if wanted is None or doc in wanted:
                        raw = tools[sha].decompress(payload[offsets[n] : offsets[n + 1]])
                        ids = np.frombuffer(raw, f"<u{row['width']}").astype("<u4").tobytes()
                        if len(ids) != 4 * count:
                            raise ValueError(f"document {doc} holds {len(ids) // 4} ids, not {count}")
                        rows.append((doc, row["shard"], at, count, zlib.crc32(ids) if digest else ids))
                    at += count
                for part in range(0, len(rows), 512):
                    yield common.batch_of(schema, list(map(list, zip(*rows[part : part + 512]))))

    names = "doc_id bigint, shard bigint, at bigint, n_tokens bigint"
    return common.mapped(blocks, decode, f"{names}, ids_crc32 bigint" if digest else f"{names}, ids binary")


def read(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """Every document's doc_id, start (ids of all documents before it), n_tokens, and ids or their crc32."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard, not a document
    offsets = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    if shards.count() <= BROADCAST_SHARDS:
        offsets = F.broadcast(offsets)
    rows = _rows(blocks, folder, digest=digest)
    start = (F.col("at") + F.col("earlier")).alias("start")
    return rows.join(offsets, "shard").select("doc_id", start, "n_tokens", rows.columns[-1])


def lookup(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of the given documents; only their blocks are read and only their frames decompressed."""
    wanted = frozenset(doc_ids)
    blocks = spark.read.parquet(f"{folder}/blocks")
    if wanted:
        blocks = blocks.where((F.col("last_doc") >= min(wanted)) & (F.col("first_doc") <= max(wanted)))
    blocks = blocks.where(F.arrays_overlap("doc_ids", F.array(*map(F.lit, sorted(wanted)))) if wanted else F.lit(False))
    return _rows(blocks, folder, wanted).select("doc_id", "ids")


def report(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write a store to the shared folder and describe each document as it is read back."""
    folder = common.shared_folder(docs.sparkSession)
    write(docs, folder, vocabulary)
    return read(docs.sparkSession, folder, digest=True)
