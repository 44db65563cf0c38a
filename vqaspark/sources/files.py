"""File sources and sinks: annotation maps, request files, image listings,
JSON prediction/comparison sinks, training-history sink (S4-S11).

JSON sinks write JSON Lines, one file per task, UTF-8 without ASCII
escaping.  Counts reported by sinks come from an ``observe()`` metric on the
write itself, not from a second job.
"""

from __future__ import annotations

import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vqaspark.operators.sampling import with_index
from vqaspark.sources.headers import file_system, read_headers
from vqaspark.sources.json_objects import read_entries

ANNOTATION = T.StructType([
    T.StructField("image_id", T.LongType()),
    T.StructField("question", T.StringType()),
    T.StructField("answer", T.StringType()),
])

ANNOTATION_FILE = T.StructType([
    T.StructField("images", T.MapType(T.StringType(), T.StringType())),
    T.StructField("annotations", T.MapType(T.StringType(), ANNOTATION)),
])

REQUEST = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("image_id", T.LongType()),
    T.StructField("image_path", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("answer", T.StringType()),
])

REQUEST_FILE = T.StructType(REQUEST.fields + [
    T.StructField("annotations", T.ArrayType(REQUEST)),
])


# ------------------------------------------------------------------ readers

def read_annotation_map(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Files of ``{"images": {id: filename}, "annotations": {ann_id:
    {image_id, question, answer}}}`` objects (one per line, or one per file
    with ``multi_line=True``, whose files are read by byte ranges, by as many
    tasks as their length gives).

    One row per annotation: ``file``, ``ann_id``, ``image_id``, ``question``,
    ``answer`` and ``filename``, looked up in the object's own image map (files
    of different splits reuse image ids).  A malformed file fails the read.
    """
    if multi_line:
        entries = read_entries(spark, path)
        one = F.concat(F.lit("{"), F.col("text"), F.lit("}"))
        fail = {"mode": "FAILFAST"}
        ann = (entries.where("section = 'annotations'")
               .select("file", F.explode(F.from_json(one, T.MapType(T.StringType(), ANNOTATION), fail)).alias("ann_id", "a"))
               .select("file", "ann_id", "a.image_id", "a.question", "a.answer"))
        images = (entries.where("section = 'images'")
                  .select("file", F.explode(F.from_json(one, T.MapType(T.StringType(), T.StringType()), fail)).alias("_image", "filename")))
        return (ann.withColumn("_image", F.col("image_id").cast("string")).join(images, ["file", "_image"], "left").drop("_image"))
    raw = (spark.read.schema(ANNOTATION_FILE).option("mode", "FAILFAST").json(path)
           .select(F.col("_metadata.file_path").alias("file"), "images", "annotations"))
    return (raw.select("file", "images", F.explode("annotations").alias("ann_id", "a"))
               .select("file", "ann_id", "a.image_id", "a.question", "a.answer",
                       F.try_element_at("images", F.col("a.image_id").cast("string")).alias("filename")))


def read_requests(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Request files in either layout -- ``{"annotations": [...]}`` or a
    bare list of request objects.

    Files of one object or list each (``multi_line``) are read by byte ranges,
    by as many tasks as their length gives; ``sample_id`` = (file, position in
    the file).  Otherwise every line holds an object, and ``sample_id`` orders
    the requests of a file as they stand in it.  It keeps requests apart that
    ask about one image.  ``id`` is the file's own, else ``image_id`` (not
    unique).  A malformed file fails the read."""
    cols = [f.name for f in REQUEST.fields]
    if multi_line:
        entries = read_entries(spark, path).where("section in ('', 'annotations')")
        out = entries.select(F.struct("file", "position").alias("sample_id"), "file",
                             F.from_json("text", REQUEST, {"mode": "FAILFAST"}).alias("r"))
        out = out.select("sample_id", "file", *[F.col(f"r.{c}").alias(c) for c in cols])
    else:
        raw = (spark.read.schema(REQUEST_FILE).option("mode", "FAILFAST").json(path)
               .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_row"), "*"))
        one = F.array(F.struct(*[F.col(c).alias(c) for c in cols]))
        out = raw.select("file", "_block", "_row", F.posexplode(F.coalesce("annotations", one)).alias("_at", "r"))
        out = out.select(F.struct("file", "_block", "_row", "_at").alias("sample_id"), "file",
                         *[F.col(f"r.{c}").alias(c) for c in cols])
    # the list form documents ``id``; the dict form ``image_id``
    return out.withColumn("id", F.coalesce("id", "image_id"))


def image_listing(spark: SparkSession, root: str, glob: str = "*.jpg",
                  recursive: bool = True, with_content: bool = False, with_header: bool = False) -> DataFrame:
    """Files under ``root`` (path, length, modificationTime).  The
    ``content`` column is pruned unless asked for, so listing never reads
    the bytes; ``with_header`` adds the first 16 of them by ranged reads (see
    ``headers``).  Only a store that Arrow's file systems cannot open is read
    by ``binaryFile``, which loads whole files of up to 2 GB."""
    if with_header and not with_content:
        try:
            file_system(root)
            return read_headers(spark, root, glob, recursive)
        except ValueError:
            pass
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
               .option("recursiveFileLookup", str(recursive).lower()).load(root))
    cols = ["path", "length", "modificationTime"] + (["content"] if with_content else [])
    head = [F.substring("content", 1, 16).alias("header")] if with_header else []
    return df.select(*cols, *head)


# -------------------------------------------------------------------- sinks

def write_json(df: DataFrame, path: str, mode: str = "overwrite", name: str = "rows") -> int:
    """Write JSON Lines (UTF-8, non-ASCII kept) and return the row count,
    measured by an observation on the write job."""
    obs = Observation(name)
    (df.observe(obs, F.count(F.lit(1)).alias("n"))
       .write.mode(mode).option("ignoreNullFields", "false").json(path))
    return int(obs.get["n"])


PREDICTION_COLS = ["image_id", "image_path", "question", "predicted_answer", "reference_answer"]


def save_predictions(df: DataFrame, path: str) -> int:
    """Prediction records (DM8)."""
    cols = [c for c in (["id"] + PREDICTION_COLS) if c in df.columns]
    return write_json(df.select(*cols), path, name="predictions")


def save_comparisons(df: DataFrame, path: str) -> int:
    """Comparison records (DM9 + sample id)."""
    return write_json(df, path, name="comparisons")


def save_report(df: DataFrame, path: str) -> int:
    """The one-row evaluation report."""
    return write_json(df.coalesce(1), path, name="report")


def dataset_to_json(df: DataFrame, path: str, order_cols=None) -> int:
    """Keep id/question/answer (drop images); missing values become
    ``''`` and a missing id becomes the row's position: in ``order_cols``
    order (unique together), or without them in scan order, which changes with
    the file layout."""
    if order_cols is None:
        df, order_cols = df.withColumn("_order", F.monotonically_increasing_id()), "_order"
    if "id" not in df.columns:
        df = with_index(df, order_cols, out="id")
    elif df.where(F.col("id").isNull()).limit(1).count() > 0:
        df = with_index(df, order_cols, out="_pos")
        df = df.withColumn("id", F.coalesce("id", "_pos"))
    q = F.col("question") if "question" in df.columns else F.lit(None)
    a = F.col("answer") if "answer" in df.columns else F.lit(None)
    out = df.select(F.col("id").cast("bigint").alias("id"),
                    F.coalesce(q.cast("string"), F.lit("")).alias("question"),
                    F.coalesce(a.cast("string"), F.lit("")).alias("answer"))
    return write_json(out, path, name="dataset")


HISTORY_SCHEMA = T.StructType([
    T.StructField("step", T.LongType()),
    T.StructField("epoch", T.DoubleType()),
    T.StructField("loss", T.DoubleType()),
    T.StructField("eval_loss", T.DoubleType()),
])


def history_sink(df: DataFrame, path: str, mode: str = "append", run_col: str | None = "run_id",
                 partition_by_run: bool = False) -> int:
    """Append training-history rows.  Rows are sorted by (run, step)
    inside each file, so parquet min/max statistics let a reader skip row
    groups of other runs; directory-per-run layout is opt-in because it
    multiplies files (runs x tasks) and one hot run would fall on one task."""
    has_run = bool(run_col and run_col in df.columns)
    cols = ([run_col] if has_run else []) + [f.name for f in HISTORY_SCHEMA.fields]
    w = df.select(*cols)
    w = w.sortWithinPartitions(*(([run_col] if has_run else []) + ["step"]))
    obs = Observation("history")
    writer = w.observe(obs, F.count(F.lit(1)).alias("n")).write.mode(mode)
    if has_run and partition_by_run:
        writer = writer.partitionBy(run_col)
    writer.parquet(path)
    return int(obs.get["n"])


_COMMITS = "_commits"      # hidden from readers of the folder


def _committed(spark: SparkSession, path: str) -> dict[str, int]:
    """Committed batches of a history and their rows: a row per batch."""
    try:
        rows = spark.read.schema("batch string, rows long").parquet(os.path.join(path, _COMMITS)).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r["batch"]: r["rows"] for r in rows}


def append_history(df: DataFrame, path: str, batch: str, run_col: str | None = "run_id") -> int:
    """S11, safe to run again: append the history rows of ``batch`` (a name of
    letters, digits, ``-`` and ``_``) once and return their number.

    The rows go to a folder of the batch, which a repeated attempt overwrites;
    the commit record comes last.  A batch with a record is left as it is, so
    a retried or replayed job adds nothing.  One writer per batch at a time;
    different batches may be written side by side."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
        raise ValueError("a batch is named by letters, digits, - and _")
    spark = df.sparkSession
    done = _committed(spark, path)
    if batch in done:
        return done[batch]
    n = history_sink(df, os.path.join(path, f"batch={batch}"), mode="overwrite", run_col=run_col)
    (spark.createDataFrame([(batch, n)], "batch string, rows long").coalesce(1)
          .write.mode("overwrite").parquet(os.path.join(path, _COMMITS, f"commit={batch}")))
    return n


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The committed batches of a history, with their ``batch``; what an
    attempt left without a commit is not read."""
    done = sorted(_committed(spark, path))
    if not done:
        return spark.createDataFrame([], T.StructType([*HISTORY_SCHEMA.fields, T.StructField("batch", T.StringType())]))
    folders = [os.path.join(path, f"batch={b}") for b in done]
    return (spark.read.option("basePath", path).parquet(*folders).withColumn("batch", F.col("batch").cast("string")))


def write_annotation_shards(samples: DataFrame, lookup: DataFrame, path: str,
                            rows_per_shard: int = 50000) -> None:
    """Write samples in the annotation-map layout as JSON Lines: each line
    is one ``{"images", "annotations"}`` object holding a bounded shard of
    rows (``rows_per_shard``), so no single object grows with the data."""
    n = samples.count()
    shards = max(1, -(-n // rows_per_shard))
    keyed = samples.withColumn("_shard", F.pmod(F.xxhash64("id"), F.lit(shards)))
    ann = keyed.groupBy("_shard").agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("id").cast("string"),
        F.struct("image_id", "question", "answer")))).alias("annotations"))
    img_keys = keyed.select("_shard", "image_id").distinct().join(lookup, "image_id")
    imgs = img_keys.groupBy("_shard").agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("image_id").cast("string"), F.col("filename")))).alias("images"))
    (ann.join(imgs, "_shard", "left").select("images", "annotations")
        .write.mode("overwrite").json(path))
