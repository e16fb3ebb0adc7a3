"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set holds its distinct five-word shingles. Documents with equal sets form a class and go on as one, under a
number of its own, since an id may stand for several texts. Every class has a signature, which is cut into TREES paths of DEPTH values; sorting the paths of a tree lexicographically puts
similar classes side by side. Where few classes share a path's first LEAST values, all of them are candidates for each other;
where many do, the region is split one value deeper, again and again, and in any case neighbours in the order, whose common
prefix is the longest, are candidates. Each sorted order is dealt out by ranges, so a large region spreads over tasks.

Candidates whose signatures agree too little for the wanted similarity are dropped, the others are confirmed on full sets. Only pairs
between different components matter, so confirmation runs in rounds: each component tries its most promising pairs, merged
components drop the pairs between them, and the rounds end when no unconfirmed pair is left between components. Last come the members of
regions that were split and still hold several components. Two sets at the wanted similarity share one of the first quarter of the larger's
shingles and the first seventh of the smaller's, in the order of how many members hold them; members that share none with another
component leave, so a template that many texts have in common makes no work. Those that stay are compared on full sets, in blocks.
So all pairs that share LEAST values of a path take part, however large a region is; a pair at the threshold is in none of the trees
with probability (1 - 0.75 ** 3) ** 16 = 0.00016, one of similarity 0.8 with 0.00001.

Defined results: texts without words are linked with nothing; fewer than five words are one shingle; rows with the same id and
text are copies of each other, of the same id and other texts are classes apart; a row without an id is in no component and kept; empty
tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm import common

SHINGLE = 5
PERCENT = 75
TREES, DEPTH, LEAST = 16, 6, 3
#: A region with more classes than this is split at the next value of the paths.
LEAF = 8
#: Neighbours in the order on either side that are candidates in a split region.
NEIGHBOURS = 2
#: Signatures of 96 values that agree in fewer belong to a pair of similarity 0.75 with probability below 0.00001.
AGREE = 53
#: Ids that are sent to all tasks at once (some 40 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Edges that one task unites on its own (some 30 MB).
EDGES_PER_TASK = 100_000
#: Rows of a sorted order in one task at least.
ORDER_ROWS = 4096
_VALUES = TREES * DEPTH
_WORDS_KEPT = 300_000
_ODD = np.random.default_rng(20240229).integers(1, 1 << 63, (2, _VALUES), dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Words()


def shingles(text: str | None) -> np.ndarray:
    """The set, as sorted 64-bit hashes."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: A-Z, and at space and \t..\r
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    value = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        value = (value + ids[k : len(ids) - size + 1 + k]) * _STEP
        value ^= value >> np.uint64(29)
    return np.unique(value)


def signature(found: np.ndarray) -> bytes:
    """MinHash values, 16 bits each, most significant byte first, tree by tree."""
    best = np.full(_VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 512):
        part = found[at : at + 512, None] * _ODD[0] + _ODD[1]
        best = np.minimum(best, part.min(0))
    mixed = (best ^ (best >> np.uint64(31))) * _STEP
    return (mixed >> np.uint64(48)).astype(">u2").tobytes()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def fingerprint(found: np.ndarray) -> bytes | None:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def described(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a fingerprint of the set and its signature (both null for the empty set), stored."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("print", pa.binary()), ("sig", pa.binary())])

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                found = shingles(text)
                rows.append((len(found), fingerprint(found), signature(found) if len(found) else None))
            yield common.batch_of(schema, [batch.column("doc_id"), *map(list, zip(*rows))])

    narrow = docs.select(F.col("doc_id").cast("bigint"), "text")
    return common.stored(common.mapped(narrow, describe, "doc_id bigint, n_shingles bigint, print binary, sig binary"))


# --- the forest ---------------------------------------------------------------------------------------------------------


@dataclass
class _Order:
    """Rows of a tree's sorted order: tree number, path and class of each."""

    tree: np.ndarray
    path: np.ndarray
    rep: np.ndarray

    def common_prefix(self) -> np.ndarray:
        """How many first values each row shares with the row before; 0 for the first."""
        same = (self.path[1:] == self.path[:-1]) & (self.tree[1:] == self.tree[:-1])[:, None]
        return np.concatenate([[0], np.cumprod(same, axis=1).sum(1)]).astype(np.int64) if len(self.rep) else np.zeros(0, np.int64)


def candidates(order: _Order, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of classes; and of each row whether its region had to be split."""
    n = len(order.rep)
    shared = order.common_prefix()
    pairs = [np.zeros((0, 2), np.int64)]
    active = np.ones(n, bool)
    crowded = np.zeros(n, bool)
    for depth in range(LEAST, DEPTH + 1):
        if not active.any():
            break
        region = np.cumsum(shared < depth) - 1
        size = np.bincount(region, minlength=region[-1] + 1)[region]
        small, large = active & (size <= leaf), active & (size > leaf)
        if depth == LEAST:
            crowded = large
        chosen = ((small & (size > 1), leaf - 1), (large, NEIGHBOURS))
        for mask, reach in chosen:
            for step in range(1, reach + 1):
                at = np.flatnonzero(mask[step:] & (region[step:] == region[:-step]))
                if not len(at):
                    break
                pairs.append(np.stack([order.rep[at], order.rep[at + step]], 1))
        active = large
    found = np.concatenate(pairs)
    found = np.unique(np.sort(found, axis=1), axis=0)
    return found[found[:, 0] != found[:, 1]], crowded


def _order(tree, path, rep) -> _Order:
    joined = b"".join(path)
    return _Order(
        np.asarray(tree, np.int64), np.frombuffer(joined, ">u2").reshape(-1, DEPTH).astype(np.int64), np.asarray(rep, np.int64)
    )


def _forest(classes: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a < b), and the members (tree, region, rep) of split regions."""
    spark = classes.sparkSession
    width = 2 * DEPTH
    trees = classes.select(
        "rep", F.posexplode(F.array(*[F.substring("sig", 1 + t * width, width) for t in range(TREES)])).alias("tree", "path")
    )
    tasks = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows * TREES // ORDER_ROWS))
    ordered = trees.repartitionByRange(tasks, "tree", "path", "rep").sortWithinPartitions("tree", "path", "rep")
    schema = pa.schema(
        [("a", pa.int64()), ("b", pa.int64()), ("seam", pa.int64()), ("tree", pa.int64()), ("path", pa.binary()),
         ("rep", pa.int64()), ("crowded", pa.bool_())]
    )
    ends = LEAF + NEIGHBOURS

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        read = [(b.column("tree").to_numpy(), b.column("path").to_pylist(), b.column("rep").to_numpy()) for b in batches]
        if not read:
            return
        tree, rep = np.concatenate([x[0] for x in read]), np.concatenate([x[2] for x in read])
        path = [value for x in read for value in x[1]]
        pairs, crowded = candidates(_order(tree, path, rep))
        none = [None] * len(pairs)
        yield common.batch_of(schema, [pairs[:, 0], pairs[:, 1], none, none, none, none, none])
        # a region may go on in the next range: both ends are looked at again, together with their neighbour's
        n = len(rep)
        for seam, at in ((part, range(min(ends, n))), (part + 1, range(max(0, n - ends), n))):
            k = list(at)
            yield common.batch_of(
                schema, [[None] * len(k), [None] * len(k), [seam] * len(k), tree[k], [path[x] for x in k], rep[k], [False] * len(k)]
            )
        k = np.flatnonzero(crowded).tolist()
        yield common.batch_of(
            schema, [[None] * len(k), [None] * len(k), [None] * len(k), tree[k], [path[x] for x in k], rep[k], [True] * len(k)]
        )

    found = common.stored(
        common.mapped(ordered, walk, "a bigint, b bigint, seam bigint, tree bigint, path binary, rep bigint, crowded boolean")
    )

    def mend(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["tree", "path", "rep"]).sort_values(["tree", "path", "rep"])
        pairs, _ = candidates(_order(rows.tree, rows.path, rows.rep))
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    seams = found.where("seam is not null").groupBy("seam").applyInPandas(mend, "a bigint, b bigint")
    pairs = found.where("a is not null").select("a", "b").unionByName(seams).distinct()
    region = F.substring("path", 1, 2 * LEAST)
    # rows at the ends of a range count too, as their region may be large only together with the next range's rows
    members = found.where("crowded or seam is not null").select("tree", region.alias("region"), "rep").distinct()
    large = members.groupBy("tree", "region").count().where(F.col("count") > LEAF).select("tree", "region")
    return pairs, members.join(large, ["tree", "region"], "left_semi")


# --- confirmation -------------------------------------------------------------------------------------------------------


def _rated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose signatures agree enough, with the number of agreeing values and both sizes allowing a link."""
    one = classes.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a"), F.col("n_shingles").alias("n_a"))
    two = classes.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"), F.col("n_shingles").alias("n_b"))
    sized = (F.least("n_a", "n_b") * 100) >= (F.greatest("n_a", "n_b") * PERCENT)
    both = pairs.join(one, "a").join(two, "b").where(sized).select("a", "b", "sig_a", "sig_b")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("agree", pa.int64())])

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (
                    np.frombuffer(b"".join(batch.column(name).to_pylist()), ">u2").reshape(-1, _VALUES) for name in ("sig_a", "sig_b")
                )
                agree = (left == right).sum(1)
                keep = np.flatnonzero(agree >= AGREE)
                yield common.batch_of(
                    schema, [batch.column("a").to_numpy()[keep], batch.column("b").to_numpy()[keep], agree[keep].astype(np.int64)]
                )

    return common.mapped(both, rate, "a bigint, b bigint, agree bigint")


def _sets(docs: DataFrame, ids: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep and its shingles for the wanted classes, stored. ``ids`` has print, doc and rep of all classes.

    A class is found by its smallest id and known by its fingerprint.
    """
    wanted = common.stored(ids.join(wanted.distinct(), "rep", "left_semi"))
    known = wanted.select("doc").distinct()
    if wanted.count() <= BROADCAST_IDS:
        wanted, known = F.broadcast(wanted), F.broadcast(known)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc"), "text").join(known, "doc", "left_semi")
    schema = pa.schema([("doc", pa.int64()), ("print", pa.binary()), ("hashes", pa.binary())])

    def hash_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            found = [shingles(text) for text in batch.column("text").to_pylist()]
            yield common.batch_of(schema, [batch.column("doc"), list(map(fingerprint, found)), [mine.tobytes() for mine in found]])

    hashed = common.mapped(texts, hash_all, "doc bigint, print binary, hashes binary").join(wanted, ["doc", "print"])
    return common.stored(hashed.select("rep", "hashes").dropDuplicates(["rep"]), "none")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Which of the pairs are links, stored: a, b, linked."""
    one = sets.select(F.col("rep").alias("a"), F.col("hashes").alias("hashes_a"))
    two = sets.select(F.col("rep").alias("b"), F.col("hashes").alias("hashes_b"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("hashes_a").to_pylist(), batch.column("hashes_b").to_pylist()
            linked = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(left, right)]
            yield common.batch_of(schema, [batch.column("a"), batch.column("b"), linked])

    both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "hashes_a", "hashes_b")
    return common.stored(common.mapped(both, compare, "a bigint, b bigint, linked boolean"))


def _local_roots(edges: DataFrame) -> DataFrame:
    """The edges of each partition, replaced by one edge from every node to the smallest it is united with there."""
    schema = pa.schema([("node", pa.int64()), ("root", pa.int64())])

    def unite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def top(k: int) -> int:
            while parent.setdefault(k, k) != k:
                parent[k] = k = parent[parent[k]]
            return k

        for batch in batches:
            for one, two in zip(batch.column("node").to_pylist(), batch.column("root").to_pylist()):
                one, two = top(one), top(two)
                parent[max(one, two)] = min(one, two)
        rows = [(node, top(node)) for node in list(parent)]
        rows = [row for row in rows if row[0] != row[1]]
        yield common.batch_of(schema, [[row[0] for row in rows], [row[1] for row in rows]])

    return common.mapped(edges, unite, "node bigint, root bigint")


def components(links: DataFrame, per_task: int = EDGES_PER_TASK) -> DataFrame:
    """node, root (the smallest node reachable) of all nodes that have a link and are not their own root.

    Tasks first unite what they hold, a bounded number of edges each. If that takes more than one task, large-star and
    small-star steps follow in turn: a logarithmic number of rounds even for long chains, each of them stored.
    """
    content = [F.count("*").alias("n"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)")).alias("hash")]
    edges = common.stored(links.where("a != b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct())
    before = edges.agg(*content).first()
    if before.n:
        tasks = -(-before.n // per_task)
        edges = common.stored(_local_roots(edges.repartition(tasks)))
        if tasks == 1:
            return edges
        before = edges.agg(*content).first()
    while True:
        both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
        starred = (
            both.join(least, "node").where("root > node and root != least").select(F.col("root").alias("node"), F.col("least").alias("root"))
        )
        # small star: neighbours below a node, and the node itself, are hung under the smallest of them
        lowest = starred.groupBy("node").agg(F.min("root").alias("least"))
        hung = starred.join(lowest, "node").select(F.explode(F.array("node", "root")).alias("node"), F.col("least").alias("root"))
        edges = common.stored(hung.where("node != root").distinct())
        now = edges.agg(*content).first()
        if now == before:
            return edges
        before = now


def _crossing(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs between different components, with the component of each side."""
    one = labels.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    two = labels.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    named = pairs.join(one, "a", "left").join(two, "b", "left")
    named = named.withColumn("root_a", F.coalesce("root_a", "a")).withColumn("root_b", F.coalesce("root_b", "b"))
    return named.where("root_a != root_b")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after links (root_a, root_b) between components, stored."""
    pairs = links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    roots = components(pairs).select(F.col("node").alias("root"), F.col("root").alias("new_root"))
    known = labels.join(roots, "root", "left").select("node", F.coalesce("new_root", "root").alias("root"))
    return common.stored(known.unionByName(roots.select(F.col("root").alias("node"), F.col("new_root").alias("root"))))


def _united(pairs: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """The labels after all links among the (rated, stored) pairs."""
    tries = 3
    while True:
        open_ = common.stored(_crossing(pairs, labels))
        if open_.isEmpty():
            return labels
        best = Window.partitionBy("root").orderBy(F.desc("agree"), "a", "b")
        sides = open_.select("a", "b", "agree", F.explode(F.array("root_a", "root_b")).alias("root"))
        picked = sides.withColumn("place", F.row_number().over(best)).where(F.col("place") <= tries).select("a", "b").distinct()
        tried = _confirmed(picked, sets)
        linked = tried.where("linked")
        if not linked.isEmpty():
            labels = _merged(labels, linked.join(open_, ["a", "b"]))
        pairs = common.stored(open_.join(tried, ["a", "b"], "left_anti").select("a", "b", "agree"))
        tries *= 8


def _tokens(sets: DataFrame) -> DataFrame:
    """rep, n (shingles of its set) and each shingle."""
    schema = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("token", pa.int64())])

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, raw in zip(batch.column("rep").to_pylist(), batch.column("hashes").to_pylist()):
                found = np.frombuffer(raw, np.int64)
                for at in range(0, len(found), 65536):
                    part = found[at : at + 65536]
                    yield common.batch_of(schema, [np.full(len(part), rep), np.full(len(part), len(found)), part])

    return common.mapped(sets, spread, "rep bigint, n bigint, token bigint")


def sharing(sets: DataFrame, roots: DataFrame) -> DataFrame:
    """The reps that may be similar to one of another component; all others certainly are not. No pairs are made.

    Of two sets similar enough, the larger one's first n - ceil(3n/4) + 1 shingles and the smaller one's first
    m - ceil(6m/7) + 1 have one in common, in any one order of all shingles. Here shingles that one component alone holds come
    first, and the others by how many hold them. ``roots`` names each rep's component.
    """
    tokens = _tokens(sets).join(roots, "rep")
    extent = [F.min("root").alias("low"), F.max("root").alias("high")]
    held = tokens.groupBy("token").agg(F.count("*").alias("holders"), *extent).where("low != high").select("token", "holders")
    shared = tokens.join(held, "token")
    order, every = Window.partitionBy("rep").orderBy("holders", "token"), Window.partitionBy("rep")
    place = F.col("n") - F.count("*").over(every) + F.row_number().over(order)
    placed = shared.withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1)
    early = F.col("place") <= F.col("n") - F.ceil(F.col("n") * (2 * PERCENT) / (100 + PERCENT)) + 1
    placed = common.stored(placed.select("token", "rep", "root", early.alias("early")))
    met = placed.groupBy("token").agg(F.max("early").alias("early"), *extent).where("early and low != high").select("token")
    return placed.join(met, "token", "left_semi").select("rep").distinct()


#: Members of a split region that one group compares: so many from outside the largest component, with so many of all.
QUERIES, MEMBERS = 256, 1024


def linking(rep: np.ndarray, root: np.ndarray, asks: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between rows that ask and the others that join their components: as many as join, not all there are.

    Exact: the shared shingles of a row with all others are counted at once, by marking its own among all.
    """
    known, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum([len(x) for x in sets])
    own = [codes[end - len(x) : end] for end, x in zip(ends, sets)]
    others = np.flatnonzero(~asks)
    if not len(others):
        return []
    sizes = np.array([len(own[k]) for k in others])
    tokens, begins = np.concatenate([own[k] for k in others]), np.cumsum(sizes) - sizes
    mark = np.zeros(len(known), bool)
    parent: dict[int, int] = {}

    def top(k: int) -> int:
        while parent.get(k, k) != k:
            parent[k] = k = parent.get(parent[k], parent[k])
        return k

    links = []
    for k in np.flatnonzero(asks):
        mark[own[k]] = True
        both = np.add.reduceat(mark[tokens], begins, dtype=np.int64)
        mark[own[k]] = False
        near = 100 * both >= PERCENT * (len(own[k]) + sizes - both)
        for other in others[np.flatnonzero(near & (root[others] != root[k]))]:
            one, two = top(int(root[k])), top(int(root[other]))
            if one != two:
                parent[max(one, two)] = min(one, two)
                links.append((int(rep[k]), int(rep[other])))
    return links


def _rest(docs: DataFrame, ids: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """The labels after all links between members of split regions.

    Members that by their rare shingles cannot be similar to any outside their component leave first. The others are compared on
    full sets, in blocks: those outside a region's largest component with all, and as many links come back as join components.
    """
    key = ["tree", "region"]
    named = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    named = common.stored(named)
    open_ = named.groupBy(*key).agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select(*key)
    named = common.stored(named.join(open_, key, "left_semi"))
    if named.isEmpty():
        return labels
    roots = common.stored(named.select("rep", "root").distinct())
    sets = _sets(docs, ids, roots.select("rep"))
    near = common.stored(sharing(sets, roots))
    named = common.stored(named.join(near, "rep", "left_semi"))
    sizes = named.groupBy(*key, "root").count()
    per_region = sizes.groupBy(*key).agg(F.sum("count").alias("n"), F.max("count").alias("most"), F.count("*").alias("roots"))
    largest = sizes.join(per_region.where("roots > 1"), key).where("count = most").groupBy(*key, "n", "most").agg(F.min("root").alias("top"))
    rows = common.stored(named.join(largest, key).withColumn("asks", F.col("root") != F.col("top")))
    if rows.isEmpty():
        return labels
    blocks = F.ceil((F.col("n") - F.col("most")) / QUERIES).cast("bigint")
    parts = F.ceil(F.col("n") / MEMBERS).cast("bigint")
    dealt = rows.join(sets, "rep").withColumn("blocks", blocks).withColumn("parts", parts)
    block, part = F.pmod(F.xxhash64("rep"), F.col("blocks")), F.pmod(F.xxhash64("rep", F.lit(1)), F.col("parts"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    shown = [*key, "rep", "root", "hashes"]
    asking = dealt.where("asks").select(*shown, F.lit(True).alias("asks"), block.alias("block"), every("parts").alias("part"))
    asked = dealt.select(*shown, F.lit(False).alias("asks"), part.alias("part"), every("blocks").alias("block"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        found = linking(rows.rep.to_numpy(), rows.root.to_numpy(), rows.asks.to_numpy(), [np.frombuffer(x, np.uint64) for x in rows.hashes])
        return pd.DataFrame(np.array(found, np.int64).reshape(-1, 2), columns=["a", "b"])

    links = asking.unionByName(asked).groupBy(*key, "block", "part").applyInPandas(compare, "a bigint, b bigint").distinct()
    links = common.stored(links)
    return labels if links.isEmpty() else _merged(labels, _crossing(links, labels))


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The described rows; and by print: component (the smallest id reachable), and the print of the text that stands for it."""
    spark, rows = docs.sparkSession, described(docs)
    ids = rows.where("print is not null and doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("doc"))
    ids = common.stored(ids.withColumn("rep", F.monotonically_increasing_id()))
    own = rows.select(F.col("doc_id").alias("doc"), "print", "n_shingles", "sig")
    classes = common.stored(own.join(ids, ["print", "doc"]).dropDuplicates(["rep"]).select("rep", "n_shingles", "sig"))
    pairs, members = _forest(classes, classes.count())
    pairs, members = common.stored(_rated(pairs, classes)), common.stored(members)
    sets = _sets(docs, ids, pairs.select(F.explode(F.array("a", "b")).alias("rep")))
    labels = _united(pairs, sets, spark.createDataFrame([], "node bigint, root bigint"))
    labels = _rest(docs, ids, members, labels)
    inside = labels.select(F.col("node").alias("rep"), "root").unionByName(labels.select(F.col("root").alias("rep"), "root")).distinct()
    first = ids.join(inside, "rep").groupBy("root").agg(F.min(F.struct("doc", "print")).alias("first"))
    standing = inside.join(first, "root").select("rep", "first")
    named = ids.join(standing, "rep", "left").select(
        "print", F.coalesce("first.doc", "doc").alias("component"), F.coalesce("first.print", "print").alias("standing")
    )
    return rows.drop("sig"), named


def labelled(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id reachable over links)."""
    rows, named = _classes(docs)
    return rows.join(named, "print", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    )


def report(docs: DataFrame) -> DataFrame:
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return labelled(docs).withColumn("kept", kept)


def _with_fingerprint(docs: DataFrame, name: str) -> DataFrame:
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            prints = [fingerprint(shingles(text)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.binary())], names=[*batch.schema.names, name])

    return common.mapped(docs, add, docs.withColumn(name, F.lit(None).cast("binary")).schema)


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One document of each component stays: the one with the smallest id, of several texts or copies under that id one.

    Texts without words and rows without an id stay. Most ids have one row, which goes or stays as a whole; only where
    an id has several are their fingerprints taken again.
    """
    rows, named = _classes(docs)
    stays = F.col("doc_id").isNull() | F.col("print").isNull() | ((F.col("doc_id") == F.col("component")) & (F.col("print") == F.col("standing")))
    found = common.stored(rows.join(named, "print", "left").select("doc_id", "print", stays.alias("stays")))
    by_id = found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"), F.count_if("stays").alias("staying"))
    decided = common.stored(by_id.where("rows > 1 or staying = 0"))

    def of(condition: str) -> DataFrame:
        some = decided.where(condition).select("doc_id")
        return F.broadcast(some) if some.count() <= BROADCAST_IDS else some

    kept = docs.join(of("true"), "doc_id", "left_anti").select(*docs.columns)
    several = of("staying > 0")
    if decided.where("staying > 0").isEmpty():
        return kept
    name = common.free_name(docs, "print")
    texts = _with_fingerprint(docs.join(several, "doc_id", "left_semi").select(*docs.columns), name)
    pairs = found.where("stays and print is not null").join(several, "doc_id", "left_semi").select("doc_id", F.col("print").alias(name)).distinct()
    one = texts.join(pairs, ["doc_id", name], "left_semi").dropDuplicates(["doc_id", name])
    return kept.unionByName(one.select(*docs.columns)).unionByName(texts.where(F.col(name).isNull()).select(*docs.columns))
