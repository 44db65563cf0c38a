"""Readers for the parquet tables the engine works on."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder, on any file system the session can list."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(at).isDirectory()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; known: {TABLES}")
    df = spark.read.parquet(table_path(sf_dir, name))
    if name == "events":
        df = df.withColumn("ts", ntz_as_utc("ts"))
    return df


def ntz_as_utc(c: str):
    """Naive (TIMESTAMP_NTZ) wall-clock values as UTC instants, whatever the
    session time zone: watermarks and windows need TIMESTAMP, and a plain
    cast would read the wall clock in the session's zone.  In a UTC session
    the cast is the same, and filters on it reach the scan."""
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z"):
        return F.col(c).cast("timestamp")
    return F.concat(F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).cast("timestamp")
