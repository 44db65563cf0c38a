"""Tables stored in an order, with positions.

``write_ordered`` range-partitions the rows by the order columns and writes one
file per range, sorted, each row with its number in the file; a manifest keeps
every file's rows and the position of its first.  Readers walk the order
without sorting again, and a row, a batch or any span of positions opens only
the files that hold it.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vqaspark.functions.hashing import shuffle_key

PART, ROW = "_part", "_row"


def write_ordered(df: DataFrame, path: str, order_cols, num_files: int | None = None) -> int:
    """Store ``df`` in ``order_cols`` order (unique together; end them with an
    id) under ``path`` and return the number of rows.

    One shuffle and one write; the manifest comes from the written files'
    footers.  A file of at most some 128-256 MB is a good size: ``num_files``
    (the session's shuffle partitions by default).  ``path`` must be new: a
    half-written store of an earlier run is no store, as it has no manifest."""
    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    spark = df.sparkSession
    n = num_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    clash = {PART, ROW} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken by the store")
    ranged = df.repartitionByRange(n, *order).withColumn(PART, F.spark_partition_id()).sortWithinPartitions(PART, *order)
    # The low 33 bits of the row id count a partition's rows from 0.
    numbered = ranged.withColumn(ROW, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    fields = [f for f in numbered.schema.fields if f.name != PART] + [numbered.schema[PART]]
    numbered.write.mode("error").partitionBy(PART).parquet(os.path.join(path, "rows"))
    spark.createDataFrame([(T.StructType(fields).json(),)], "value string").coalesce(1).write.mode("error").text(os.path.join(path, "schema"))
    manifest = first_positions(_rows(spark, path), PART)
    manifest.coalesce(1).write.mode("error").parquet(os.path.join(path, "manifest"))
    return count(spark, path)


def first_positions(rows: DataFrame, part_col: str) -> DataFrame:
    """(part, rows, first) of rows numbered by parts in order: a row per part,
    summed up on the driver."""
    counts = rows.groupBy(part_col).agg(F.count(F.lit(1)).alias("rows")).collect()
    out, first = [], 0
    for part, n in sorted((r[part_col], r["rows"]) for r in counts):
        out.append((part, n, first))
        first += n
    return rows.sparkSession.createDataFrame(out, f"{part_col} int, rows long, first long")


def _rows(spark: SparkSession, path: str, parts: list[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(spark.read.text(os.path.join(path, "schema")).first()[0]))
    root = os.path.join(path, "rows")
    folders = [root] if parts is None else [os.path.join(root, f"{PART}={p}") for p in parts]
    return spark.read.schema(schema).option("basePath", root).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{PART} int, rows long, first long").parquet(os.path.join(path, "manifest"))


def count(spark: SparkSession, path: str) -> int:
    """Rows of a store, from its manifest."""
    return int(_manifest(spark, path).agg(F.coalesce(F.max(F.col("first") + F.col("rows")), F.lit(0))).first()[0])


def read_span(spark: SparkSession, path: str, lo: int, hi: int, out: str = "position") -> DataFrame:
    """The rows at positions ``lo`` to ``hi`` - 1 with their position.  Only
    the files of that span are listed and opened, and in them only the row
    groups of its rows."""
    held = _manifest(spark, path).where((F.col("first") < hi) & (F.col("first") + F.col("rows") > lo))
    parts = sorted((r[PART], r["first"]) for r in held.collect())          # a row per file of the span
    inner = _rows(spark, path, [p for p, _ in parts])
    cols = [F.col(f"`{c}`") for c in inner.columns if c not in (PART, ROW)]
    if len(parts) == 1:
        # Within a file, rows are stored by their number, so its statistics cut row groups.
        first = parts[0][1]
        return (inner.where((F.col(ROW) >= lo - first) & (F.col(ROW) < hi - first))
                .select(*cols, (F.col(ROW) + F.lit(first)).alias(out)))
    at = spark.createDataFrame(parts, f"{PART} int, first long")
    return (inner.join(at, PART).withColumn(out, F.col("first") + F.col(ROW))
            .where((F.col(out) >= lo) & (F.col(out) < hi)).select(*cols, out))


def read_ordered(spark: SparkSession, path: str, out: str = "position") -> DataFrame:
    """All rows with their position.  Each file is one range of positions, in
    order inside; nothing is shuffled but the manifest's rows."""
    rows = _rows(spark, path)
    cols = [F.col(f"`{c}`") for c in rows.columns if c not in (PART, ROW)]
    return rows.join(_manifest(spark, path), PART).select(*cols, (F.col("first") + F.col(ROW)).alias(out))


def get_row(spark: SparkSession, path: str, index: int, out: str = "index") -> DataFrame:
    """The row at ``index`` (no row beyond the end); one file is opened."""
    if index < 0:
        raise ValueError("index must be >= 0")
    return read_span(spark, path, index, index + 1, out)


def get_batch(spark: SparkSession, path: str, number: int, batch_size: int) -> DataFrame:
    """Batch ``number`` of ``batch_size`` consecutive rows, with
    ``batch_pos``; the files of that batch are opened."""
    if batch_size <= 0 or number < 0:
        raise ValueError("batch_size must be positive and the number not negative")
    lo = number * batch_size
    return read_span(spark, path, lo, lo + batch_size, "batch_pos").withColumn("batch_pos", F.col("batch_pos") - F.lit(lo))


def store_shuffled(df: DataFrame, path: str, id_col: str = "id", seed: int = 42, num_files: int | None = None) -> int:
    """O1/M5: store the whole seeded shuffle: rows in (md5(seed:id), id) order.
    The key stays with the rows as ``shuffle_key``."""
    keyed = df.withColumn("shuffle_key", shuffle_key(id_col, seed))
    return write_ordered(keyed, path, ["shuffle_key", id_col], num_files)
