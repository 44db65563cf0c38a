"""Exact match (A2, A3), teacher/student agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vqaspark.functions.text import normalize_answer

METRIC_NAMES = ("exact_match", "partial_match", "rouge_l", "bertscore_f1")


def check_metric(name: str) -> str:
    """Unknown metric names fail fast, on the driver, before any job."""
    if name not in METRIC_NAMES:
        raise ValueError(f"no metric {name!r}; there are {', '.join(METRIC_NAMES)}")
    return name


def _group(df: DataFrame, group_by):
    if group_by is None:
        return df.groupBy()
    return df.groupBy(*([group_by] if isinstance(group_by, str) else group_by))


def em_flag(pred, ref) -> Column:
    """1.0 when strip+lower forms are equal, else 0.0 (NULL never matches)."""
    p = normalize_answer(pred)
    r = normalize_answer(ref)
    return F.when(p.isNotNull() & r.isNotNull() & (p == r), F.lit(1.0)).otherwise(F.lit(0.0))


def exact_match(df: DataFrame, pred: str = "prediction", ref: str = "reference",
                group_by=None) -> DataFrame:
    """A2: mean match over all rows; an empty input gives 0.0, not an error."""
    return _group(df, group_by).agg(
        F.count(F.lit(1)).alias("num_samples"),
        F.coalesce(F.avg(em_flag(pred, ref)), F.lit(0.0)).alias("exact_match"))


def exact_match_labeled(df: DataFrame, pred: str = "predicted_answer",
                        ref: str = "reference_answer", group_by=None,
                        strict_denominator: bool = False) -> DataFrame:
    """A3: rows without a reference are skipped.  As in the reference, the
    numerator counts matches against every non-NULL reference (also ``''``)
    while the denominator counts only non-empty ones; ``strict_denominator``
    uses the non-NULL count instead.  No labelled rows -> 0.0."""
    r = F.col(ref)
    hit = F.when(r.isNotNull(), em_flag(pred, ref)).otherwise(F.lit(0.0))
    denom_cond = r.isNotNull() if strict_denominator else (r.isNotNull() & (r != ""))
    g = _group(df, group_by).agg(
        F.sum(hit).alias("matches"),
        F.count_if(denom_cond).alias("labeled"))
    return g.withColumn(
        "exact_match",
        F.when(F.col("labeled") > 0, F.col("matches") / F.col("labeled")).otherwise(F.lit(0.0))
    ).withColumn("matches", F.col("matches").cast("bigint"))


def agree_flag(teacher, student) -> Column:
    """``t.lower() == s.lower()`` -- no strip, as the reference."""
    t = F.col(teacher) if isinstance(teacher, str) else teacher
    s = F.col(student) if isinstance(student, str) else student
    return F.coalesce(F.lower(t) == F.lower(s), F.lit(False))


def agreement(df: DataFrame, teacher: str = "teacher_answer", student: str = "student_answer",
              group_by=None) -> DataFrame:
    """Share of rows where teacher and student agree (0.0 when empty)."""
    flag = F.when(agree_flag(teacher, student), F.lit(1.0)).otherwise(F.lit(0.0))
    return _group(df, group_by).agg(
        F.count(F.lit(1)).alias("num_samples"),
        F.sum(flag).cast("bigint").alias("agreements"),
        F.coalesce(F.avg(flag), F.lit(0.0)).alias("agreement"))
