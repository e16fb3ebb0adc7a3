"""Building blocks that keep joins and rankings whole when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.session import ensure_checkpoint_dir

# A key with more rows than this is handled apart from the others.
HOT_ROWS = 1_000_000
# The hot threshold rises with the table so that no more than this many keys can exceed it;
# that makes every broadcast of hot keys bounded, whatever the data.
MAX_HOT_KEYS = 100_000

TASKS_PER_CORE = 3
# Spark's own number of shuffle partitions.
USUAL_PARTITIONS = 200

_POSITION_BITS = (1 << 33) - 1


def hot_threshold(rows: int, hot_rows: int = HOT_ROWS) -> int:
    return max(hot_rows, rows // MAX_HOT_KEYS)


def checkpointed(df: DataFrame, **counters: Column) -> tuple[DataFrame, dict[str, int]]:
    """Reliable checkpoint, with aggregates over the stored rows."""
    ensure_checkpoint_dir(df.sparkSession)
    saved = df.checkpoint()
    if not counters:
        return saved, {}
    counted = saved.agg(*[value.alias(name) for name, value in counters.items()]).first()
    return saved, {name: counted[name] or 0 for name in counters}


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows by ``keys`` in three tasks a core, or in ``spark.sql.shuffle.partitions`` tasks where that is raised for large tables.

    For steps that cost time for each row: short texts are few bytes, so adaptive execution, and the reader of a small file,
    would put millions of rows into a handful of tasks. Every task of a shuffle writes for every other, so there are not more.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return df.repartition(max(tasks, partitions) if partitions > USUAL_PARTITIONS else tasks, *keys)


def one_per_key(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    pick: Callable[[Column], Column] = F.min,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per ``key``: the smallest (or what ``pick`` finds) in ``order``, which names all other columns.

    Keys are counted on their own first, and the repeated ones kept. Rows with a key of their own pass through, without being
    sorted or combined, and without a shuffle unless more than MAX_HOT_KEYS keys are repeated; only repeated ones meet in an
    aggregate, which combines copies before the shuffle, so a key with very many is no hot spot. ``then`` is applied to the rows once it is known which of the two they are; it must keep the columns.
    """
    then = then or (lambda df: df)
    counted = rows.groupBy(key).agg(F.count("*").alias("_copies")).where("_copies > 1").select(key)
    repeated, extent = checkpointed(counted, keys=F.count("*"))
    if not extent["keys"]:
        return then(rows).select(key, *order)
    if extent["keys"] <= MAX_HOT_KEYS:
        repeated = F.broadcast(repeated)
    several = then(rows.join(repeated, key, "left_semi")).groupBy(key).agg(pick(F.struct(*order)).alias("_best"))
    chosen = several.select(key, *[F.col("_best")[name].alias(name) for name in order])
    return then(rows.join(repeated, key, "left_anti")).select(key, *order).unionByName(chosen)


def hot_keys(probe: DataFrame, key: str, rows: int, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys of ``probe`` above the hot threshold (at most MAX_HOT_KEYS), or None when there cannot be any."""
    if rows <= hot_rows:
        return None
    return (
        probe.where(F.col(key).isNotNull())
        .groupBy(key)
        .count()
        .where(F.col("count") > hot_threshold(rows, hot_rows))
        .select(key)
    )


def lookup(probe: DataFrame, build: DataFrame, key: str, spread: str, hot: DataFrame | None = None) -> DataFrame:
    """Left-join ``probe`` to ``build`` (one row per ``key``), adding the other build columns.

    Rows whose key is null, or listed in ``hot``, are placed by a hash of the ``spread`` column instead of the key, so
    neither missing keys nor one popular key pile up in a single task. Keys are text or BIGINT. Hot keys, whether or not they have a build row, are
    answered by a broadcast; ``hot`` must be bounded, as ``hot_keys`` guarantees.
    """
    payload = [name for name in build.columns if name != key]
    packed = build.select(F.col(key).alias("_key"), F.struct(*payload).alias("_found"))
    answers = [F.col("_found")]
    pending = F.col(key).isNotNull()
    columns = probe.columns
    if hot is not None:
        wanted = hot.select(F.col(key).alias("_key"))
        known = packed.join(F.broadcast(wanted), "_key", "left_semi")
        answered = wanted.join(F.broadcast(known), "_key", "left").select(
            F.col("_key").alias("_hot_key"), F.col("_found").alias("_hot_found")
        )
        probe = probe.join(F.broadcast(answered), F.col(key) == F.col("_hot_key"), "left")
        answers.insert(0, F.col("_hot_found"))
        pending = pending & F.col("_hot_key").isNull()
    elsewhere = F.xxhash64(spread).cast(dict(probe.dtypes)[key])
    placed = probe.withColumn("_pending", pending).withColumn(
        "_at", F.when(F.col("_pending"), F.col(key)).otherwise(elsewhere)
    )
    joined = placed.join(packed, (F.col("_at") == F.col("_key")) & F.col("_pending"), "left")
    return joined.withColumn("_answer", F.coalesce(*answers)).select(
        *columns, *[F.col("_answer")[name].alias(name) for name in payload]
    )


def ordered_index(df: DataFrame, order: Sequence[str], name: str, group: Sequence[str] = ()) -> DataFrame:
    """Add a dense 0-based position in ``order`` (a total order), per ``group`` if given.

    Rows are range-partitioned, so a group of any size is spread over tasks: position = rows of the group in earlier
    ranges + position inside the range. The offset table has one row per range and group seen there; callers pass a
    bounded number of groups. The ranges are checkpointed because a recomputed range sample may cut elsewhere.
    """
    group = list(group)
    ranged = (
        df.repartitionByRange(*group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_position", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)))
    )
    ranged, _ = checkpointed(ranged)
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range", *group)
        .agg(F.count("*").alias("_rows"), F.min("_position").alias("_start"))
        .select(
            "_range",
            *group,
            (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_start")).alias("_shift"),
        )
    )
    return (
        ranged.join(F.broadcast(offsets), ["_range", *group])
        .withColumn(name, F.col("_position") + F.col("_shift"))
        .select(*df.columns, name)
    )
