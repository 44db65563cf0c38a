"""Partial match (A4): mean ``difflib.SequenceMatcher(None, pred, ref).ratio()``
over rows with a reference.

The ratio has no SQL form, so it runs in an Arrow UDF (stdlib difflib, one
call per row, whole strings).  The ratio is asymmetric in its arguments and
``autojunk`` (on by default, as in the reference) changes scores for
references of 200+ characters; both are kept as parameters.
"""

from __future__ import annotations

import difflib
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@lru_cache(maxsize=1 << 16)
def _short_ratio(p: str, r: str, autojunk: bool) -> float:
    return difflib.SequenceMatcher(None, p, r, autojunk=autojunk).ratio()


def ratio(pred, ref, autojunk: bool = True) -> float:
    """``SequenceMatcher(None, pred, ref).ratio()`` after strip+lower.  Short
    pairs (answers repeat a lot) are memoised per Python worker; long texts
    are scored directly, whole."""
    p = str(pred).strip().lower()
    r = str(ref).strip().lower()
    if len(p) + len(r) <= 256:
        return _short_ratio(p, r, autojunk)
    return difflib.SequenceMatcher(None, p, r, autojunk=autojunk).ratio()


def _make_udf(autojunk: bool):
    @F.pandas_udf(T.DoubleType())
    def _ratio(p: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([None if y is None else ratio(x, y, autojunk) for x, y in zip(p, r)],
                         dtype="float64")
    return _ratio


_UDFS = {True: _make_udf(True), False: _make_udf(False)}


def partial_match_scores(df: DataFrame, pred: str = "predicted_answer", ref: str = "reference_answer",
                         out: str = "partial_match", autojunk: bool = True) -> DataFrame:
    """Per-row ratio; NULL where the reference is NULL.  A NULL prediction is
    compared as the text ``none``, exactly like ``str(None)``."""
    return df.withColumn(out, _UDFS[bool(autojunk)](F.col(pred), F.col(ref)))


def partial_match(df: DataFrame, pred: str = "predicted_answer", ref: str = "reference_answer",
                  group_by=None, autojunk: bool = True) -> DataFrame:
    s = partial_match_scores(df.where(F.col(ref).isNotNull()), pred, ref, "_pm", autojunk)
    g = s.groupBy() if group_by is None else s.groupBy(group_by)
    return g.agg(F.count(F.lit(1)).alias("num_scored"),
                 F.coalesce(F.avg("_pm"), F.lit(0.0)).alias("partial_match"))
