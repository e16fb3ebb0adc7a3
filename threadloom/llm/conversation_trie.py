"""A trie of conversation prefixes, from whole sequences of turns that are collapsed before any prefix is expanded.

Conversations are rebuilt first: one that begins like another (its base) takes that one's first turns. A sequence's
prefixes are known by sums of hashes of (place, turn), 120 bits, so the hash of every prefix is a running sum. Equal
conversations collapse to one weighted sequence, and only distinct sequences are expanded to prefixes. Sequences whose hash
is that of a proper prefix of another leave by an anti-join; the rest are the leaves. The prefixes are then grouped:
members are sums of weights, childless nodes sums of leaves.

What a subtree saves needs no walk through it. The smallest member of a node is also the smallest member of the node below it on
its own path, so the nodes that one sequence gives its name to are the end of its path. The characters below a node are
therefore sums over the sequences through it: all the characters that follow, times the sequence's weight, less those that
follow within the part that bears its name.

Places are counted and hashes summed within ranges of rows, and what earlier ranges hold is added from a table of the few
conversations that go over several ranges; a conversation may hold most rows. The lists of the conversations that end at a node are
joined to text in ranges too, and its SHA-256 reads the pieces as a stream.

Defined results: turns come in the order of their number (missing first), then role, then text; equal turns count each; a missing role
or text is empty; rows without conv_id belong to no conversation and are left out; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm import common

#: Conversations are bases of those whose ids follow up to the next multiple, by at most SHARED - 1 turns.
FAMILY = 100
SHARED = 6
#: Turns of a conversation that one task orders, and children of a node that are joined to it by one task.
BLOCK_TURNS = 100_000
HOT_CHILDREN = 100_000
#: At most so many nodes can count as hot, since the limit grows with the number of nodes.
HOT_NODES = 10_000
#: Characters of ids joined to one piece.
PIECE = 1 << 16
_HASHES = 4
_BITS = (1 << 30) - 1  # sums of 30-bit numbers over 2^33 turns stay below 2^63


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), digest and length of the text of every turn, in order.

    The rows are range-partitioned in order, so a conversation of any length is spread over tasks.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    known = conversations.where("conv_id is not null").select(F.col("conv_id").cast("bigint"), "turn", role.alias("role"), text.alias("text"))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    ranged = (
        known.repartitionByRange("conv_id", "turn", "role", "text")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
        .select(
            "conv_id", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("row"),
            digest.alias("digest"), F.length("text").cast("bigint").alias("chars"),
        )
    )
    ranged = common.stored(ranged)  # a recomputed sample of the ranges may cut elsewhere
    within = Window.partitionBy("range", "conv_id").orderBy("row")
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("range", "conv_id").count()
        .withColumn("before", F.sum("count").over(earlier))
        .where("before is not null")
        .select("range", "conv_id", "before")
    )  # at most one conversation comes into a range from the one before
    return (
        ranged.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), ["range", "conv_id"], "left")
        .select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "digest", "chars")
    )


def _block(place: str = "place", block: int = BLOCK_TURNS) -> Column:
    return F.floor(F.col(place) / block)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, block, place, digest, chars, n_turns), and all conversations with n_turns."""
    own = common.stored(turns(conversations))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("int")
    heads = (
        own.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < SHARED - 1))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "digest", "chars"))).alias("head"))  # at most SHARED - 1
    )
    counted = own.groupBy("conv_id").agg(F.count("*").alias("own")).select("conv_id", "own", base.alias("base"), shared.alias("h"))
    taken = F.when(F.col("h") > 0, F.slice("head", F.lit(1), F.greatest("h", F.lit(1))))
    families = counted.join(heads, "base", "left").select("conv_id", "own", "h", taken.alias("head"))
    n_taken = F.coalesce(F.size("head"), F.lit(0))
    rest = F.greatest(F.col("own") - F.col("h"), F.lit(0))
    families = common.stored(families.withColumn("taken", n_taken).withColumn("n_turns", F.col("taken") + rest))
    first = families.select("conv_id", "n_turns", F.inline("head")).select("conv_id", "place", "digest", "chars", "n_turns")
    # A conversation's facts are repeated for each block of its turns, so that the turns of a long one meet in many tasks.
    blocks = families.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("own") - 1) / BLOCK_TURNS))))
    kept = own.withColumn("block", _block()).join(blocks, ["conv_id", "block"]).where("place >= h")
    after = kept.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "digest", "chars", "n_turns")
    both = first.unionByName(after).withColumn("block", _block())
    return both, families.select("conv_id", "n_turns")


def prefixes(sequences: DataFrame) -> DataFrame:
    """conv_id, block, depth, node and parent node (text keys), chars of the last turn and of all turns up to it, n_turns."""
    whole = F.concat(F.col("place").cast("string").cast("binary"), F.lit(b":"), F.col("digest"))
    hashes = [F.xxhash64(F.lit(k), whole).bitwiseAND(F.lit(_BITS)).alias(f"h{k}") for k in range(_HASHES)]
    sums = [*(f"h{k}" for k in range(_HASHES)), "chars"]
    rows = sequences.select("conv_id", "block", "place", "chars", "n_turns", *hashes)
    upto = Window.partitionBy("conv_id", "block").orderBy("place")
    rows = rows.withColumns({f"s_{name}": F.sum(name).over(upto) for name in sums})
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = sequences.where(F.col("n_turns") > BLOCK_TURNS).select("conv_id", "block", "chars", *hashes)
    totals = totals.groupBy("conv_id", "block").agg(*[F.sum(name).alias(name) for name in sums])
    before = totals.select("conv_id", "block", *[F.sum(name).over(earlier).alias(f"b_{name}") for name in sums])
    rows = rows.join(before, ["conv_id", "block"], "left")
    full = {name: F.col(f"s_{name}") + F.coalesce(F.col(f"b_{name}"), F.lit(0)) for name in sums}

    def key(depth: Column, *parts: Column) -> Column:
        return F.concat_ws(".", depth.cast("string"), *[F.lower(F.hex(part)) for part in parts])

    depth = F.col("place") + 1
    own = [full[f"h{k}"] for k in range(_HASHES)]
    up = [full[f"h{k}"] - F.col(f"h{k}") for k in range(_HASHES)]
    return rows.select(
        "conv_id", "block", depth.alias("depth"), key(depth, *own).alias("node"), key(depth - 1, *up).alias("parent"),
        "chars", full["chars"].alias("chars_upto"), "n_turns",
    )


ROOT = ".".join(["0"] * (_HASHES + 1))


def ends(paths: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, the node where it ends, and its number of turns and characters."""
    last = paths.where("depth = n_turns").select("conv_id", "node", "n_turns", F.col("chars_upto").alias("chars"))
    none = conversations.where("n_turns = 0").select("conv_id", F.lit(ROOT).alias("node"), "n_turns", F.lit(0).cast("bigint").alias("chars"))
    return last.unionByName(none)


def end_lists(ended: DataFrame) -> DataFrame:
    """By node: the SHA-256 of the ids that end there, ascending and joined by commas.

    Ids are sorted in ranges and joined to pieces of text there; a node with most of the ids has pieces in many ranges. Its hash is
    one computation over all of them, but reads one piece after the other.
    """

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held, size, number = None, [], 0, 0
        done: list[tuple[str, int, str]] = []
        for batch in batches:
            for key, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if key != node or size >= PIECE:
                    if held:
                        done.append((node, held[0], ",".join(map(str, held))))
                    node, held, size = key, [], 0
                held.append(conv)
                size += 12
            if len(done) >= 1000:
                yield common.batch_of(pieces, list(map(list, zip(*done))))
                done = []
        if held:
            done.append((node, held[0], ",".join(map(str, held))))
        if done:
            yield common.batch_of(pieces, list(map(list, zip(*done))))

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for key, text in zip(batch.column("node").to_pylist(), batch.column("piece").to_pylist()):
                if key != node:
                    if state is not None:
                        done.append((node, state.hexdigest()))
                    node, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if done:
                yield common.batch_of(hashed, list(map(list, zip(*done))))
        if state is not None:
            yield common.batch_of(hashed, [[node], [state.hexdigest()]])

    pieces = pa.schema([("node", pa.string()), ("first", pa.int64()), ("piece", pa.string())])
    hashed = pa.schema([("node", pa.string()), ("ends_sha256", pa.string())])
    ordered = ended.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    joined = common.mapped(ordered, join, "node string, first bigint, piece string")
    together = joined.repartition("node").sortWithinPartitions("node", "first").select("node", "piece")
    return common.mapped(together, digest, "node string, ends_sha256 string")


def trie(conversations: DataFrame, hot_children: int = HOT_CHILDREN) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    sequences, whole = rebuilt(conversations)
    paths = common.stored(prefixes(sequences))
    ended = common.stored(ends(paths, whole))
    distinct = ended.groupBy("node").agg(
        F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"), F.max("n_turns").alias("n_turns"), F.max("chars").alias("all_chars")
    )
    distinct = common.stored(distinct)
    # Expanded once for each distinct sequence, by the rows of its smallest conversation.
    last_block = F.greatest(F.floor((F.col("n_turns") - 1) / BLOCK_TURNS), F.lit(0))
    chosen = distinct.select(
        "conv_id", "weight", "all_chars", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)).alias("block")
    )
    below_root = paths.join(chosen, ["conv_id", "block"])
    proper = below_root.where("depth < n_turns").select("node").unionByName(
        distinct.where("n_turns > 0").limit(1).select(F.lit(ROOT).alias("node"))
    )
    leaves = distinct.join(proper.distinct(), "node", "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    facts = distinct.select("conv_id", "weight", "all_chars", "n_turns").join(leaves, "conv_id", "left").fillna(0, ["leaf"])
    marks = facts.select("conv_id", "leaf").join(chosen.select("conv_id", "block"), "conv_id")
    columns = ["conv_id", "node", "parent", "depth", "weight", "leaf", "chars", "after"]
    root = facts.select(
        "conv_id", F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("bigint").alias("depth"),
        "weight", "leaf", F.lit(0).cast("bigint").alias("chars"), F.col("all_chars").alias("after"),
    )
    # ``after``: characters of the turn at this depth and of all that follow on this sequence.
    expanded = below_root.join(marks, ["conv_id", "block"]).withColumn("after", F.col("all_chars") - F.col("chars_upto") + F.col("chars"))
    expanded = common.stored(expanded.select(*columns).unionByName(root.select(*columns)))
    nodes = common.stored(
        expanded.groupBy("node").agg(
            F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.sum("weight").alias("n_convs"),
            F.sum("leaf").cast("bigint").alias("n_leaves"), F.max("chars").alias("chars"),
        )
    )
    # From which depth on a sequence names its nodes, and the characters from there on.
    named = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "node")).alias("top")).select(
        "conv_id", F.col("top.depth").alias("top"), F.col("top.node").alias("node")
    )
    named = named.join(expanded.select("conv_id", "node", F.col("after").alias("named")), ["conv_id", "node"]).drop("node")
    counted = expanded.groupBy("conv_id").agg(F.count("*").alias("rows")).join(named, "conv_id", "left")
    slots = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("rows") - 1) / BLOCK_TURNS)))
    by_slot = counted.select("conv_id", slots.alias("slot"), "top", F.coalesce("named", F.lit(0)).alias("named"))
    own = F.when(F.col("top").isNotNull() & (F.col("depth") >= F.col("top")), F.col("after")).otherwise(F.col("named"))
    saved = (
        expanded.withColumn("slot", F.floor(F.col("depth") / BLOCK_TURNS))
        .join(by_slot, ["conv_id", "slot"])
        .groupBy("node")
        .agg(F.sum(F.col("weight") * F.col("after") - own).cast("bigint").alias("saved_tokens"))
    )
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    full = (
        nodes.join(saved, "node")
        .join(children, "node", "left")
        .join(end_lists(ended), "node", "left")
        .withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "ends_sha256": F.coalesce("ends_sha256", F.lit(_NO_ENDS))})
    )
    full = common.stored(full)
    return with_parents(full, hot_children)


_NO_ENDS = hashlib.sha256(b"").hexdigest()


def with_parents(nodes: DataFrame, hot_children: int = HOT_CHILDREN) -> DataFrame:
    """parent_conv_id: below the top of its named part a node's parent has the same name; only tops look their parents up.

    Parents of very many children answer by a broadcast.
    """
    kept = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    top = nodes.groupBy("conv_id").agg(F.min("depth").alias("top"))
    limit = max(hot_children, nodes.count() // HOT_NODES)
    popular = nodes.where(F.col("n_children") > limit).select(F.col("node").alias("parent"), F.col("conv_id").alias("hot_conv_id"))
    tops = nodes.join(top, "conv_id").where("depth = top").join(F.broadcast(popular), "parent", "left")
    others = nodes.where(F.col("n_children").between(1, limit)).select(F.col("node").alias("parent"), F.col("conv_id").alias("found"))
    answered = tops.where("hot_conv_id is not null or parent is null").select("node", F.col("hot_conv_id").alias("above"))
    asked = tops.where("hot_conv_id is null and parent is not null").select("node", "parent").join(others, "parent")
    known = answered.unionByName(asked.select("node", F.col("found").alias("above"))).withColumn("is_top", F.lit(True))
    above = F.when(F.col("is_top"), F.col("above")).otherwise(F.col("conv_id"))
    joined = nodes.join(known, "node", "left")
    return joined.select(
        "conv_id", "depth", above.alias("parent_conv_id"),
        *[F.col(name).cast("string" if name == "ends_sha256" else "bigint").alias(name) for name in kept[2:]],
    )


def report(conversations: DataFrame) -> DataFrame:
    return trie(conversations)
