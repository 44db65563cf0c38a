"""Seeded shuffles, splits, positional index and batching.

Positions are computed without an unpartitioned window: rows are
range-partitioned on the order key, each partition numbers its own rows, and
the per-partition counts (one number per partition, never the data) give
every partition its offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vqaspark.functions.hashing import hash_choice, shuffle_key
from vqaspark.session import reliable_checkpoint


def first_n(df: DataFrame, n: int, order_cols, distributed: bool = False) -> DataFrame:
    """The first ``n`` rows in ``order_cols`` order, for any ``n``; the order
    columns must be unique together (end them with an id), or tied rows at the
    cut are picked arbitrarily.

    A top-k by default (n rows per partition meet in one task).
    ``distributed`` takes the same rows by the positional index, for an ``n``
    that one task should not merge; the caller chooses, never the size."""
    n = max(0, int(n))
    if isinstance(order_cols, str):
        order_cols = [order_cols]
    if not distributed:
        return df.orderBy(*order_cols).limit(n)
    return with_index(df, order_cols, out="_first_n_pos").where(F.col("_first_n_pos") < n).drop("_first_n_pos")


def with_shuffle_key(df: DataFrame, id_col: str = "id", seed: int = 42,
                     out: str = "shuffle_key") -> DataFrame:
    """O1: add the md5(seed:id) key; ordering by it is the seeded shuffle."""
    return df.withColumn(out, shuffle_key(id_col, seed))


def sample_n(df: DataFrame, n: int, id_col: str = "id", seed: int = 42, distributed: bool = False) -> DataFrame:
    """O2: the first ``n`` rows of the seeded shuffle (see ``first_n``)."""
    return first_n(with_shuffle_key(df, id_col, seed), n, ["shuffle_key", id_col], distributed)


def hash_split(df: DataFrame, id_col: str = "id", seed: int = 42,
               fractions=(0.8, 0.1, 0.1), names=("train", "dev", "test"),
               out: str = "split") -> DataFrame:
    """Split by a 0..99 hash bucket.  A row's split never changes as the
    data grows or is re-partitioned (unlike ``randomSplit``)."""
    if len(fractions) != len(names):
        raise ValueError("fractions and names must have the same length")
    if abs(sum(fractions) - 1.0) > 1e-9:
        raise ValueError("fractions must sum to 1")
    return df.withColumn(out, hash_choice(id_col, fractions, names, seed))


def with_index(df: DataFrame, order_cols, out: str = "index",
               num_partitions: int | None = None) -> DataFrame:
    """0-based position of every row in ``order_cols`` order.

    Two passes over a checkpointed, range-partitioned copy: (1) rows per
    partition, (2) offset + position inside the partition.  The checkpoint
    pins the partition layout so both passes see the same one, and cuts
    lineage so a lost executor recomputes from it, not from the source.

    ``order_cols`` should be unique (ids; md5 key + id; scan order): rows
    sharing one order value cannot be split across range partitions, and
    their relative positions would be undefined anyway.
    """
    if isinstance(order_cols, str):
        order_cols = [order_cols]
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order_cols)
                .sortWithinPartitions(*order_cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = reliable_checkpoint(ranged)
    # One number per partition; their running sums come back as a small table.
    counts = sorted((r["_pid"], r["n"]) for r in ranged.groupBy("_pid").agg(F.count("*").alias("n")).collect())
    offsets, acc = [], 0
    for pid, rows in counts:
        offsets.append((pid, acc))
        acc += rows
    first = spark.createDataFrame(offsets, "_pid int, _first bigint")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    cols = [F.col(f"`{c}`") for c in df.columns if c != out]
    return ranged.join(F.broadcast(first), "_pid").select(*cols, (F.col("_first") + local).alias(out))


def get_sample(df: DataFrame, index: int, order_cols="id", distributed: bool = False) -> DataFrame:
    """The row at ``index`` (0-based) in ``order_cols`` order (unique
    together).  By default the last of the first ``index + 1`` rows (a top-k,
    no full pass); ``distributed`` uses the positional index instead."""
    index = int(index)
    if isinstance(order_cols, str):
        order_cols = [order_cols]
    if index < 0:
        raise ValueError("index must be >= 0")
    if distributed:
        return with_index(df, order_cols).where(F.col("index") == index)
    head = df.orderBy(*order_cols).limit(index + 1)
    cols = df.columns
    # one aggregate over the <= index + 1 head rows: the last one and the
    # count (fewer rows than index + 1 = out of range, no row)
    agg = head.agg(F.max_by(F.struct(*cols), F.struct(*order_cols)).alias("_r"),
                   F.count(F.lit(1)).alias("_n"))
    return (agg.where(F.col("_n") == index + 1)
               .select(*[F.col(f"_r.{c}").alias(c) for c in cols])
               .withColumn("index", F.lit(index).cast("bigint")))


def assign_batches(df: DataFrame, batch_size: int, order_cols="id",
                   out: str = "batch_id") -> DataFrame:
    """Consecutive batches of ``batch_size`` rows in ``order_cols`` order
    (every row lands in exactly one batch; nothing is dropped)."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    idx = with_index(df, order_cols)
    return (idx.withColumn(out, F.expr(f"index div {int(batch_size)}"))
               .withColumn("batch_pos", (F.col("index") % F.lit(batch_size)).cast("bigint")))


def preview_topk(df: DataFrame, k: int = 5, order_col: str = "id") -> DataFrame:
    """First ``k`` rows by ``order_col`` (a top-k report)."""
    return df.orderBy(order_col).limit(int(k))
