"""Distributed batch prediction with a pluggable model.

A model is any picklable factory returning a callable
``pandas.DataFrame -> sequence of answers`` (columns: image path, question).
An iterator pandas UDF over these two columns streams Arrow batches to it, so
every other column (ids above all) stays in the JVM untouched; the factory
runs at most once per Python worker (module-level cache, worker reuse on).

Row errors are isolated: if a batch call raises, the batch is retried row by
row and failing rows come out with an ``error`` (class) and its message
instead of being dropped, so the caller can route them to a dead-letter table.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Iterator, Tuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MODEL_CACHE: dict = {}
_ANSWER = T.StructType([T.StructField("answer", T.StringType()), T.StructField("error", T.StringType()),
                        T.StructField("message", T.StringType())])


def _load(factory: Callable, key: str):
    model = _MODEL_CACHE.get(key)
    if model is None:
        model = factory()
        _MODEL_CACHE[key] = model
    return model


def _factory_key(factory) -> str:
    return getattr(factory, "cache_key", None) or f"{type(factory).__module__}.{type(factory).__qualname__}:{factory!r}"


def _run_batch(model, pdf: pd.DataFrame) -> pd.DataFrame:
    """Answers of one batch; rows the model raises on carry class and message."""
    try:
        answers = list(model(pdf))
        if len(answers) != len(pdf):
            raise ValueError(f"model returned {len(answers)} answers for {len(pdf)} rows")
        rows = [(None if a is None else str(a), None, None) for a in answers]
    except Exception:  # noqa: BLE001 - isolate the failing rows
        rows = []
        for i in range(len(pdf)):
            try:
                a = list(model(pdf.iloc[i:i + 1]))[0]
                rows.append((None if a is None else str(a), None, None))
            except Exception as e:  # noqa: BLE001
                rows.append((None, type(e).__name__, str(e)))
    return pd.DataFrame(rows, columns=["answer", "error", "message"], dtype=object)


def _answers(model_factory: Callable, batch_size: int) -> Callable[..., Column]:
    key = _factory_key(model_factory)

    @F.pandas_udf(_ANSWER)
    def run(batches: Iterator[Tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        model = _load(model_factory, key)
        for image, question in batches:
            view = pd.DataFrame({"image_path": image, "question": question})
            parts = [_run_batch(model, view.iloc[i:i + batch_size].reset_index(drop=True))
                     for i in range(0, len(view), batch_size)]
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=["answer", "error", "message"])

    return run


def _with_answers(df: DataFrame, models: dict[str, Callable], question_col: str, image_col: str,
                  batch_size: int) -> DataFrame:
    """Append a struct column for each model.  ``explode`` of one element keeps
    filters on the answers above the model call (it runs once per row) and lets
    filters on other columns through to the scan."""
    image = F.col(image_col).cast("string") if image_col in df.columns else F.lit(None).cast("string")
    for name, factory in models.items():
        answer = _answers(factory, batch_size)(image, F.col(question_col))
        df = df.select("*", F.explode(F.array(answer)).alias(name))
    return df


def predict(df: DataFrame, model_factory: Callable, question_col: str = "question",
            image_col: str = "image_path", out: str = "predicted_answer",
            batch_size: int = 32, error_col: str = "error") -> DataFrame:
    """Add ``out`` (answer), ``error_col`` (exception class or NULL) and
    ``<error_col>_message``."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    return _with_answers(df, {"_p": model_factory}, question_col, image_col, batch_size).select(
        *cols, F.col("_p.answer").alias(out), F.col("_p.error").alias(error_col),
        F.col("_p.message").alias(f"{error_col}_message"))


def predict_ok(df: DataFrame, model_factory: Callable, **kw) -> DataFrame:
    """Prediction records of rows the model answered."""
    err = kw.get("error_col", "error")
    return predict(df, model_factory, **kw).where(F.col(err).isNull()).drop(err, f"{err}_message")


def dead_letter(df: DataFrame, model_factory: Callable, **kw) -> DataFrame:
    """The rows the model failed on, with the error class and message."""
    err = kw.get("error_col", "error")
    return predict(df, model_factory, **kw).where(F.col(err).isNotNull())


def predict_pair(df: DataFrame, teacher_factory: Callable, student_factory: Callable,
                 question_col: str = "question", image_col: str = "image_path",
                 batch_size: int = 32) -> DataFrame:
    """Teacher and student on the same rows in one pass (no join): adds
    ``teacher_answer``, ``student_answer``, ``teacher_error``,
    ``student_error`` (class and message, NULL if it answered) and ``match``
    (false unless both answered alike)."""
    from vqaspark.operators.metrics.exact import agree_flag
    cols = [F.col(f"`{c}`") for c in df.columns]
    both = _with_answers(df, {"_t": teacher_factory, "_s": student_factory}, question_col, image_col, batch_size)

    def error(m):
        return F.when(F.col(f"{m}.error").isNotNull(), F.concat_ws(": ", f"{m}.error", f"{m}.message"))

    return (both.select(*cols, F.col("_t.answer").alias("teacher_answer"), F.col("_s.answer").alias("student_answer"),
                        error("_t").alias("teacher_error"), error("_s").alias("student_error"))
            .withColumn("match", agree_flag("teacher_answer", "student_answer")))


def pair_dead_letter(df: DataFrame, teacher_factory: Callable, student_factory: Callable, **kw) -> DataFrame:
    """Rows on which the teacher, the student or both failed."""
    return predict_pair(df, teacher_factory, student_factory, **kw).where(
        "teacher_error is not null or student_error is not null")


def to_prediction_records(df: DataFrame, id_col: str = "id",
                          answer_col: str = "answer") -> DataFrame:
    """Project to the prediction record (DM8); a missing reference
    answer becomes NULL."""
    ref = F.col(answer_col) if answer_col in df.columns else F.lit(None).cast("string")
    return df.select(id_col, "image_id", "image_path", "question", "predicted_answer",
                     ref.alias("reference_answer"))


def synthetic_labels(labelled: DataFrame, unlabelled: DataFrame, teacher_factory: Callable,
                     num_samples: int | None = None, id_col: str = "id", seed: int = 42) -> DataFrame:
    """M7: the teacher answers unlabelled questions; the new rows (all, or a
    seeded sample of ``num_samples``) are unioned with the labelled set."""
    from vqaspark.operators.sampling import sample_n
    pool = unlabelled
    if num_samples:
        pool = sample_n(pool, num_samples, id_col, seed).drop("shuffle_key")
    labelled_new = (predict_ok(pool, teacher_factory, out="answer")
                    .withColumn("source", F.lit("synthetic")))
    base = labelled.withColumn("source", F.lit("labelled"))
    cols = [id_col, "question", "answer", "source"]
    return base.select(*cols).unionByName(labelled_new.select(*cols))


def predict_split(df: DataFrame, model_factory: Callable, path: str, **kw):
    """Run the model once and route rows: predictions are written to
    ``path`` partitioned by ``status`` (ok / error) and read back as
    ``(ok, dead_letter)``.  Both outputs come from one model pass, and the
    written table is the recovery point if an executor is lost later."""
    err = kw.get("error_col", "error")
    out = predict(df, model_factory, **kw).withColumn(
        "status", F.when(F.col(err).isNull(), F.lit("ok")).otherwise(F.lit("error")))
    out.write.mode("overwrite").partitionBy("status").parquet(path)
    table = df.sparkSession.read.parquet(path)
    return (table.where(F.col("status") == "ok").drop("status", err, f"{err}_message"),
            table.where(F.col("status") == "error").drop("status"))


def predict_from_requests(spark, path: str, model_factory: Callable, limit: int | None = None,
                          multi_line: bool = True, **kw) -> DataFrame:
    """U3 ``predict_from_json``: request file (either layout) -> first
    ``limit`` requests -> drop invalid ones -> predict -> prediction records
    (rows the model failed on are left out, as in the reference; use
    ``predict_split`` to keep them)."""
    from vqaspark.operators.prepare import limit_then_filter
    from vqaspark.sources.files import read_requests
    req = limit_then_filter(read_requests(spark, path, multi_line=multi_line), limit, "sample_id")
    return to_prediction_records(predict_ok(req, model_factory, **kw))
