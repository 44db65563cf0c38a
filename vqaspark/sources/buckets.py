"""Tables stored by the hash of a key (J3, J4): joins and counts on the key
read each bucket where it lies, without a shuffle."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from vqaspark.session import scratch_path


def store_bucketed(df: DataFrame, name: str, key, buckets: int, path: str | None = None) -> DataFrame:
    """Store ``df`` as table ``name`` in ``buckets`` files by ``key``, sorted in
    each, and return the stored table.

    Tables that are to meet must have equal keys, of the same types, and equal
    numbers of buckets; a bucket of 128-256 MB is a good size.  The rows are
    dealt by the key first, so that a bucket is one file and not one per task.
    A hot key makes its bucket large: that is the price of this layout, and
    such tables are better joined unstored, where Spark splits them."""
    key = [key] if isinstance(key, str) else list(key)
    spark = df.sparkSession
    spark.sql(f"drop table if exists `{name}`")
    where = path or os.path.join(scratch_path(spark, "buckets"), name)
    (df.repartition(buckets, *key).write.mode("overwrite").bucketBy(buckets, key[0], *key[1:]).sortBy(key[0], *key[1:])
       .option("path", where).saveAsTable(name))
    return spark.table(name)


def bucketing_of(spark: SparkSession, name: str) -> tuple[int, list[str]] | None:
    """(buckets, key) of a stored table, or None if it is not bucketed."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe extended `{name}`").collect()}
    if "Num Buckets" not in rows:
        return None
    return int(rows["Num Buckets"]), [c.strip(" `") for c in rows["Bucket Columns"].strip("[]").split(",")]
