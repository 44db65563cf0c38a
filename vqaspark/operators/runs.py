"""Training-log and checkpoint analytics.

Every operator is grouped by run; per-run "first/last/best" picks are
``min_by``/``max_by`` aggregates (partial aggregation, no sort, no window),
so a run with a huge log still aggregates map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def log_history(df: DataFrame, logging_steps: int = 10, step_col: str = "step") -> DataFrame:
    """L1: keep every ``logging_steps``-th step; eval loss only where present."""
    if logging_steps <= 0:
        raise ValueError("logging_steps must be positive")
    return df.where(F.col(step_col) % logging_steps == 0)


def best_eval_step(df: DataFrame, run_col: str = "run_id") -> DataFrame:
    """L2: per run, the minimum eval loss and its step (first step on ties)."""
    ev = df.where(F.col("eval_loss").isNotNull())
    key = F.struct(F.col("eval_loss"), F.col("step"))
    return ev.groupBy(run_col).agg(
        F.count(F.lit(1)).alias("num_evals"),
        F.min("eval_loss").alias("best_eval_loss"),
        F.min_by("step", key).alias("best_step"))


def last_log(df: DataFrame, run_col: str = "run_id") -> DataFrame:
    """L3: the last log entry of each run (``log_history[-1]``)."""
    return df.groupBy(run_col).agg(
        F.max("step").alias("step"),
        F.max_by(F.struct("epoch", "loss", "eval_loss"), "step").alias("_last")).select(
        run_col, "step", "_last.epoch", "_last.loss", "_last.eval_loss")


def checkpoint_step(name_col: str = "name"):
    """DM12: numeric suffix of ``checkpoint-<n>`` (NULL if not numeric)."""
    return F.regexp_extract(F.col(name_col), r"-(\d+)$", 1).try_cast("bigint") \
        if hasattr(F.Column, "try_cast") else F.expr(f"try_cast(regexp_extract({name_col}, '-(\\\\d+)$', 1) as bigint)")


def latest_checkpoint(ckpts: DataFrame, run_col: str = "run_id", name_col: str = "name") -> DataFrame:
    """L4: per run, the checkpoint with the largest *numeric* step (text order
    would put ``checkpoint-9`` after ``checkpoint-10``)."""
    c = ckpts.where(F.col(name_col).startswith("checkpoint-")).withColumn("_n", checkpoint_step(name_col))
    c = c.where(F.col("_n").isNotNull())
    return c.groupBy(run_col).agg(F.max("_n").alias("step"),
                                  F.max_by(name_col, "_n").alias("latest_checkpoint"))


def checkpoint_retention(ckpts: DataFrame, keep: int = 2, run_col: str = "run_id",
                         name_col: str = "name") -> DataFrame:
    """The ``keep`` newest checkpoints per run (``save_total_limit``).

    Window partitioned by run; Spark plans the rank filter as a
    WindowGroupLimit, so each task keeps only ``keep`` rows per run before
    the shuffle."""
    c = (ckpts.where(F.col(name_col).startswith("checkpoint-"))
              .withColumn("_n", checkpoint_step(name_col)).where(F.col("_n").isNotNull())
              .select(run_col, name_col, "_n").distinct())
    w = Window.partitionBy(run_col).orderBy(F.col("_n").desc(), F.col(name_col))
    return (c.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= keep)
             .select(run_col, name_col, F.col("_n").alias("step"), "rank"))


def run_summary(df: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Per run totals -- steps, last epoch, mean/min/last loss."""
    return df.groupBy(run_col).agg(
        F.count(F.lit(1)).alias("num_logs"),
        F.max("step").alias("total_steps"),
        F.max_by("epoch", "step").alias("final_epoch"),
        F.round(F.avg("loss"), 6).alias("mean_loss"),
        F.min("loss").alias("min_loss"),
        F.max_by("loss", "step").alias("final_loss"))


def loss_by_interval(df: DataFrame, interval: int = 50, run_col: str = "run_id") -> DataFrame:
    """Mean training loss per ``interval``-step bucket of each run."""
    b = F.floor(F.col("step") / F.lit(interval)).cast("bigint")
    return df.groupBy(run_col, b.alias("bucket")).agg(
        F.count(F.lit(1)).alias("num_logs"),
        F.round(F.avg("loss"), 6).alias("mean_loss"),
        F.round(F.avg("eval_loss"), 6).alias("mean_eval_loss"))
