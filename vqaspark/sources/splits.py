"""Split datasets (S1, S2, S12): one table with a ``split`` partition column.

On disk a dataset is ``<root>/split=<name>/part-*.parquet``; filtering on
``split`` prunes whole directories before any file is opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VQA_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("image_id", T.LongType()),
    T.StructField("question", T.StringType()),
    T.StructField("answer", T.StringType()),
    T.StructField("split", T.StringType()),
])


def write_splits(df: DataFrame, path: str, split_col: str = "split",
                 mode: str = "overwrite", max_records_per_file: int = 5_000_000) -> None:
    """Write a dataset partitioned by split.  No shuffle by split: that
    would send the whole train split (80 %) to one task.  Each task writes at
    most one file per split it holds (the writer sorts its rows by split), and
    files are capped at ``max_records_per_file`` rows."""
    (df.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(split_col).parquet(path))


def load_splits(spark: SparkSession, path: str,
                schema: T.StructType = VQA_SCHEMA) -> DataFrame:
    """All splits with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).parquet(path)


def available_splits(df: DataFrame, split_col: str = "split") -> list[str]:
    """Distinct split names (partition values; a tiny aggregate)."""
    return sorted(r[0] for r in df.select(split_col).distinct().collect())


def stored_splits(spark: SparkSession, path: str, split_col: str = "split") -> list[str]:
    """Split names of a written dataset, from its partition directories (no
    job over the data; any file system the session can list)."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{split_col}="))


def get_split(df: DataFrame, name: str, split_col: str = "split",
              check: bool = True, known: list[str] | None = None) -> DataFrame:
    """One split; an unknown name raises ``ValueError`` with the names
    there are (``known``, e.g. ``stored_splits(spark, path)``; without it they
    are read from the data)."""
    if check:
        avail = available_splits(df, split_col) if known is None else known
        if name not in avail:
            raise ValueError(f"no split {name!r}; there are: {', '.join(avail) or 'none'}")
    return df.where(F.col(split_col) == name)
