"""User functions over a DataFrame.

``map_rows`` / ``map_batches`` are the Spark form of a dataset ``map`` with
``remove_columns`` and ``batched=True``: the function sees pandas batches
(Arrow transfer), never single rows, and columns it drops are pruned before
the Python stage.  Prefer native column expressions when the logic allows.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vqaspark.operators.predict import predict


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema,
                input_cols=None, remove_columns=()) -> DataFrame:
    """Apply ``fn`` to each pandas batch; ``schema`` describes its output.

    Integers of a column with nulls arrive as Python ints and ``None`` (never
    as floats, which would change ids above 2^53)."""
    cols = list(input_cols) if input_cols else [c for c in df.columns if c not in set(remove_columns)]
    out = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches):
        for b in batches:
            res = fn(b.to_pandas(integer_object_nulls=True))
            yield pa.RecordBatch.from_pandas(res[arrow.names], schema=arrow, preserve_index=False)
    return df.select(*cols).mapInArrow(run, out)


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema: T.StructType,
             input_cols=None, remove_columns=()) -> DataFrame:
    """Row function (``batched=False``) applied inside batches."""
    names = [f.name for f in schema.fields]

    def batch_fn(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [fn(r) for r in pdf.to_dict("records")]
        return pd.DataFrame(out, columns=names, dtype=object)
    return map_batches(df, batch_fn, schema, input_cols, remove_columns)


def predict_single(spark: SparkSession, model_factory, image_path: str, question: str) -> str | None:
    """One request through the same distributed path (a one-row frame)."""
    df = spark.createDataFrame([(0, image_path, question)], "id long, image_path string, question string")
    row = predict(df, model_factory).first()
    if row["error"] is not None:
        raise RuntimeError(f"model failed: {row['error']}: {row['error_message']}")
    return row["predicted_answer"]
