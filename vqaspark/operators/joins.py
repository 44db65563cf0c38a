"""The joins hidden in the reference's loops.

Everything joins on a stable key, never on list position.  Join strategy is
left to AQE (broadcast when the runtime size is under the threshold,
sort-merge otherwise, skewed partitions split); only the model registry, a
literal table of a few rows, is broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vqaspark.operators.metrics.exact import agree_flag
from vqaspark.operators.prepare import image_path_column


def attach_image_paths(samples: DataFrame, lookup: DataFrame, root: str,
                       image_col: str = "image_id", out: str = "image_path") -> DataFrame:
    """Image id -> filename from the annotation ``images`` map, else
    ``%012d.jpg``; prefixed by ``root``."""
    lk = lookup.select(F.col("image_id").alias("_lk_id"), F.col("filename").alias("_lk_name"))
    j = samples.join(lk, samples[image_col] == lk["_lk_id"], "left")
    return (j.withColumn(out, image_path_column(F.col(image_col), F.col("_lk_name"), root))
             .drop("_lk_id", "_lk_name"))


def plain_path(c) -> "F.Column":
    """One form for a path: ``file:`` scheme and repeated slashes after it are
    dropped and ``%XX`` of a URI is decoded, so that a listing's
    ``file:/a/b%20c`` and a plain ``/a/b c`` compare equal.  Other schemes keep
    their ``scheme://bucket`` prefix."""
    col = F.col(c) if isinstance(c, str) else c
    is_uri = F.regexp_like(col, F.lit("^[a-zA-Z][a-zA-Z0-9+.-]*:/"))
    # "+" is a plain character in a path; url_decode would make it a space
    decoded = F.try_url_decode(F.regexp_replace(col, F.lit("\\+"), F.lit("%2B")))
    return F.when(is_uri, F.regexp_replace(F.coalesce(decoded, col), F.lit("^file:/+"), F.lit("/"))).otherwise(col)


def _listing_paths(listing: DataFrame, path_col: str = "path") -> DataFrame:
    return listing.select(plain_path(path_col).alias("_file_path"))


def image_exists(samples: DataFrame, listing: DataFrame, path_col: str = "image_path") -> DataFrame:
    """Samples whose image file is in the listing (left semi join)."""
    files = _listing_paths(listing)
    return samples.join(files, plain_path(samples[path_col]) == files["_file_path"], "left_semi")


def image_missing(samples: DataFrame, listing: DataFrame, path_col: str = "image_path") -> DataFrame:
    """Samples whose image file is absent (left anti join)."""
    files = _listing_paths(listing)
    return samples.join(files, plain_path(samples[path_col]) == files["_file_path"], "left_anti")


def image_manifest_counts(samples: DataFrame, listing: DataFrame,
                          path_col: str = "image_path") -> DataFrame:
    """Kept and missing counts in one aggregate over one join."""
    files = _listing_paths(listing).distinct().withColumn("_exists", F.lit(True))
    j = samples.join(files, plain_path(samples[path_col]) == files["_file_path"], "left")
    return j.agg(F.count_if(F.col("_exists").isNotNull()).alias("kept"),
                 F.count_if(F.col("_exists").isNull()).alias("missing"))


def align_predictions(preds: DataFrame, refs: DataFrame, key, check: bool = True,
                      pred_col: str = "prediction", ref_col: str = "reference") -> DataFrame:
    """Predictions <-> references on ``key``.  With ``check`` every key
    must occur exactly once on each side (the reference's equal-length,
    position-aligned lists), verified in one job: per-key counts of both
    sides (map-side partial counts) joined full-outer; any key with a count
    other than 1 on either side raises ``ValueError``.  ``check="lazy"``
    folds the same check into the join itself (one shuffle per side; the
    error is raised when the result is computed)."""
    key = [key] if isinstance(key, str) else list(key)
    if check == "lazy":
        return _align_lazy(preds, refs, key, pred_col, ref_col)
    if check:
        p = preds.groupBy(*key).agg(F.count(F.lit(1)).alias("_p"))
        r = refs.groupBy(*key).agg(F.count(F.lit(1)).alias("_r"))
        bad = (p.join(r, key, "full_outer")
                .where(~((F.coalesce("_p", F.lit(0)) == 1) & (F.coalesce("_r", F.lit(0)) == 1)))
                .limit(1).count())
        if bad:
            raise ValueError(ALIGN_ERROR)
    return preds.select(*key, pred_col).join(refs.select(*key, ref_col), key, "inner")


ALIGN_ERROR = "cannot align: both sides need one row per key, and the same keys"


def _align_lazy(preds: DataFrame, refs: DataFrame, key, pred_col: str, ref_col: str) -> DataFrame:
    """One pass: each side is counted per key by a window (its only shuffle,
    hash-partitioned by the key); the full outer join reuses that
    partitioning, and a row with a missing side or a repeated key makes the
    job fail with ``ALIGN_ERROR`` when the result is computed."""
    w = Window.partitionBy(*key)
    p = preds.select(*key, pred_col).withColumn("_np", F.count(F.lit(1)).over(w))
    r = refs.select(*key, ref_col).withColumn("_nr", F.count(F.lit(1)).over(w))
    j = p.join(r, key, "full_outer")
    ok = (F.coalesce(F.col("_np"), F.lit(0)) == 1) & (F.coalesce(F.col("_nr"), F.lit(0)) == 1)
    return (j.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit(ALIGN_ERROR)).cast("boolean")))
             .select(*key, pred_col, ref_col))


def compare_models(teacher: DataFrame, student: DataFrame, key, how: str = "inner",
                   teacher_col: str = "teacher_answer", student_col: str = "student_answer",
                   extra_cols=()) -> DataFrame:
    """Teacher and student answers side by side with the ``match``
    flag (lower-case equality, no strip).  ``how='full_outer'`` exposes ids
    only one model answered instead of truncating like ``zip``."""
    key = [key] if isinstance(key, str) else list(key)
    t = teacher.select(*key, *extra_cols, teacher_col)
    s = student.select(*key, student_col)
    j = t.join(s, key, how)
    return j.withColumn("match", agree_flag(teacher_col, student_col))


# The model catalogue (id, parameter count, role).
MODEL_REGISTRY_ROWS = [
    ("7B-base", "7B", "base_model_for_training"),
    ("7B-trained", "7B", "teacher_model"),
    ("2B-distilled", "2B", "student_model_distilled"),
]

REGISTRY_SCHEMA = T.StructType([
    T.StructField("model_id", T.StringType()),
    T.StructField("params", T.StringType()),
    T.StructField("purpose", T.StringType()),
])


def model_registry(spark: SparkSession, rows=None) -> DataFrame:
    """The catalogue; only the literal one (three rows) is marked for broadcast."""
    if rows:
        return spark.createDataFrame(rows, REGISTRY_SCHEMA)
    return F.broadcast(spark.createDataFrame(MODEL_REGISTRY_ROWS, REGISTRY_SCHEMA))


def model_registry_join(df: DataFrame, registry: DataFrame, model_col: str = "model_id") -> DataFrame:
    """Attach registry attributes; Spark picks the join from the sizes."""
    return df.join(registry, df[model_col] == registry["model_id"], "left").drop(registry["model_id"])
