"""ROUGE-L F1 (A5).

Tokenisation is native (regex + split, codegen); only the longest common
subsequence runs in Python, as a bit-parallel LCS over Arrow batches: one
big-integer pass per token of the shorter side, O(n * m / wordsize).
Whole texts are scored; nothing is cut.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vqaspark.functions.text import tokens


def lcs_length(a, b) -> int:
    """Length of the longest common subsequence of two token sequences."""
    if len(a) == 0 or len(b) == 0:
        return 0
    if len(a) < len(b):
        a, b = b, a
    # bit i of masks[t] is set when a[i] == t
    masks: dict = {}
    get = masks.get
    for i, t in enumerate(a):
        masks[t] = get(t, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for t in b:
        m = get(t)
        if m is not None:  # a token absent from ``a`` leaves the row unchanged
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


@F.pandas_udf(T.IntegerType())
def lcs_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(x if x is not None else (), y if y is not None else ())
                      for x, y in zip(a, b)], dtype="int32")


def f1_score(p, r) -> float:
    p = p if p is not None else ()
    r = r if r is not None else ()
    if len(p) == 0 or len(r) == 0:
        return 0.0
    lcs = lcs_length(p, r)
    if lcs == 0:
        return 0.0
    prec, rec = lcs / len(p), lcs / len(r)
    return 2.0 * prec * rec / (prec + rec)


@F.pandas_udf(T.DoubleType())
def _rouge_f1(p: pd.Series, r: pd.Series) -> pd.Series:
    return pd.Series([f1_score(x, y) for x, y in zip(p, r)], dtype="float64")


def _f1_arrow(a, b):
    """Arrow-native scorer: one dictionary encoding per batch (C++) turns the
    tokens of both sides into ints, so no Python string is built per token."""
    import pyarrow as pa
    import pyarrow.compute as pc
    fa, fb = a.flatten(), b.flatten()
    codes = pc.dictionary_encode(pa.chunked_array([fa, fb]).combine_chunks()).indices
    codes = codes.to_numpy(zero_copy_only=False)
    ca, cb = codes[:len(fa)], codes[len(fa):]
    oa, ob = a.offsets.to_numpy(), b.offsets.to_numpy()
    va = a.is_valid().to_numpy(zero_copy_only=False)
    vb = b.is_valid().to_numpy(zero_copy_only=False)
    out = []
    for i in range(len(a)):
        x = ca[oa[i] - oa[0]:oa[i + 1] - oa[0]].tolist() if va[i] else ()
        y = cb[ob[i] - ob[0]:ob[i + 1] - ob[0]].tolist() if vb[i] else ()
        out.append(f1_score(x, y))
    return pa.array(out, type=pa.float64())


if hasattr(F, "arrow_udf"):
    _scorer = F.arrow_udf(_f1_arrow, T.DoubleType())
else:  # older PySpark: pandas batches
    _scorer = _rouge_f1

rouge_f1_udf = _scorer


@F.pandas_udf(T.ArrayType(T.StringType()))
def stem_udf(toks: pd.Series) -> pd.Series:
    from vqaspark.functions.porter import stem
    return pd.Series([None if t is None else [stem(w) if len(w) > 3 else w for w in t]
                      for t in toks])


def rouge_tokens(c, tokenizer: str = "ascii", stem: bool = False) -> Column:
    """Tokens as the scorer sees them (the reference strips and lower-cases
    first; stripping cannot change tokens and the tokenisers lower-case, so
    neither is repeated), optionally Porter-stemmed for words over 3 chars."""
    t = tokens(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), tokenizer)
    return stem_udf(t) if stem else t


def rouge_l_scores(df: DataFrame, pred: str = "prediction", ref: str = "reference",
                   out: str = "rouge_l", tokenizer: str = "ascii", stem: bool = True) -> DataFrame:
    """Per-row ROUGE-L F1 on stemmed tokens, as the scorer is used (``stem=False``: words as they are; NULL text scores like an empty one: 0)."""
    pt = rouge_tokens(pred, tokenizer, stem)
    rt = rouge_tokens(ref, tokenizer, stem)
    # One generated row: filters on the score stay above the UDF (one call per
    # row), filters on other columns still reach the scan.
    kept = [F.col(f"`{c}`") for c in df.columns if c != out]
    return df.select(*kept, F.explode(F.array(rouge_f1_udf(pt, rt))).alias(out))


def rouge_l(df: DataFrame, pred: str = "prediction", ref: str = "reference", group_by=None,
            tokenizer: str = "ascii", stem: bool = True) -> DataFrame:
    """Mean ROUGE-L F1 (0.0 for an empty input)."""
    s = rouge_l_scores(df, pred, ref, "_score", tokenizer, stem)
    g = s.groupBy() if group_by is None else s.groupBy(group_by)
    return g.agg(F.count(F.lit(1)).alias("num_samples"),
                 F.coalesce(F.avg("_score"), F.lit(0.0)).alias("rouge_l"))
