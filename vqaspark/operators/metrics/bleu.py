"""BLEU (A14): clipped n-gram precision with brevity penalty.

A row is a sample, and its counts are local to it: one Arrow-batched function
counts each row's n-grams (clipped matches and totals per n), and one
aggregate sums 2 * max_n numbers; no n-gram text is shuffled.  Single reference
per sample, uniform weights, no smoothing (a zero precision gives 0).
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _row_counts(hyp, ref, max_n: int) -> list[int]:
    """Lengths, then clipped matches and hypothesis n-grams for n = 1 ..."""
    h, r = list(hyp) if hyp is not None else [], list(ref) if ref is not None else []
    out = [len(h), len(r)]
    for n in range(1, max_n + 1):
        a, b = (Counter(zip(*[x[i:] for i in range(n)])) for x in (h, r))
        out += [sum((a & b).values()), max(len(h) - n + 1, 0)]
    return out


def _counter(max_n: int):
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def counts(hyp: pd.Series, ref: pd.Series) -> pd.Series:
        return pd.Series([_row_counts(h, r, max_n) for h, r in zip(hyp, ref)])
    return counts


def bleu(df: DataFrame, hyp: str = "hyp_tokens", ref: str = "ref_tokens", max_n: int = 4, group_by=None) -> DataFrame:
    """Corpus BLEU-``max_n`` per group (one row when ``group_by`` is None)."""
    gcols = [] if group_by is None else ([group_by] if isinstance(group_by, str) else list(group_by))
    rows = df.select(*gcols, _counter(max_n)(F.col(hyp), F.col(ref)).alias("_c"))
    sums = (rows.groupBy(*gcols) if gcols else rows.groupBy()).agg(
        *[F.coalesce(F.sum(F.col("_c")[i]), F.lit(0)).alias(f"_{i}") for i in range(2 + 2 * max_n)])
    clipped, total = [F.col(f"_{2 + 2 * i}") for i in range(max_n)], [F.col(f"_{3 + 2 * i}") for i in range(max_n)]
    nonzero = sum((F.when(x > 0, 1).otherwise(0) for x in clipped), F.lit(0))
    logs = sum((F.when(x > 0, F.log(x / t)).otherwise(0.0) for x, t in zip(clipped, total)), F.lit(0.0))
    stats = sums.select(*gcols, F.col("_0").alias("hyp_len"), F.col("_1").alias("ref_len"),
                        nonzero.alias("_nonzero"), logs.alias("_sumlog"))
    c, r = F.col("hyp_len").cast("double"), F.col("ref_len").cast("double")
    bp = F.when(c > r, F.lit(1.0)).when(c == 0, F.lit(0.0)).otherwise(F.exp(F.lit(1.0) - r / c))
    score = F.when(F.coalesce(F.col("_nonzero"), F.lit(0)) < max_n, F.lit(0.0)).otherwise(
        bp * F.exp(F.col("_sumlog") / F.lit(float(max_n))))
    return stats.select(*gcols, F.col("hyp_len").cast("bigint").alias("hyp_len"),
                        F.col("ref_len").cast("bigint").alias("ref_len"),
                        F.round(score, 6).alias("bleu"))
