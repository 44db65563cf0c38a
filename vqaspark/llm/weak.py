"""Weak supervision: several labellers vote good (1), bad (0) or abstain (-1);
expectation-maximisation estimates how often each is right, and turns every
combination of votes into a posterior probability of being good.

A combination of votes is a *pattern*.  Rows are counted by pattern on the
executors, so the driver sees at most 3^labellers counts, whatever the corpus
size; the fitted posterior goes back as an equally bounded broadcast table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LABELLERS = 8        # 3^8 = 6,561 patterns: the bound of everything collected


def pattern_codes(votes: np.ndarray) -> np.ndarray:
    """Votes (rows x labellers, values -1, 0, 1) as one base-3 number per row."""
    return (votes + 1) @ (3 ** np.arange(votes.shape[1]))


def pattern_votes(codes: np.ndarray, labellers: int) -> np.ndarray:
    return (codes[:, None] // (3 ** np.arange(labellers))[None, :]) % 3 - 1


def fit(codes, counts, labellers: int, prior_good: float = 0.8, hit: float = 0.35,
        false_alarm: float = 0.02, anchor: float = 0.05, rounds: int = 200, tolerance: float = 1e-9) -> dict:
    """Two-class EM with conditionally independent labellers.

    Each labeller has, for each class, a probability of voting bad when it
    votes; abstaining says nothing.  It starts where a bad vote is rarely wrong
    (``false_alarm`` on good rows) while every single labeller sees only some
    kinds of bad rows (``hit``), and pseudo-rows worth ``anchor`` of the table
    stay there.  That fixes which class is "good" and lets kinds of bad rows
    that trip different labellers share the bad class.
    Returns ``prior``, ``table`` [class, labeller, bad/good] and ``accuracy``
    (probability that a cast vote is right).  No rows: the start values."""
    codes, counts = np.asarray(codes, np.int64), np.asarray(counts, np.float64)
    votes = pattern_votes(codes, labellers)
    start = np.empty((2, labellers, 2))
    start[0] = [hit, 1 - hit]
    start[1] = [false_alarm, 1 - false_alarm]
    pseudo = start * (1 + anchor * counts.sum())
    table, prior = start.copy(), prior_good
    seen = np.stack([votes == v for v in (0, 1)], -1)
    last = -np.inf
    for _ in range(rounds if counts.sum() else 0):
        logp = np.einsum("pjv,cjv->pc", seen, np.log(table)) + np.log([1 - prior, prior])
        top = logp.max(1, keepdims=True)
        total = top + np.log(np.exp(logp - top).sum(1, keepdims=True))
        post = np.exp(logp - total) * counts[:, None]
        like = float((total[:, 0] * counts).sum() / counts.sum())
        table = np.einsum("pc,pjv->cjv", post, seen) + pseudo
        table /= table.sum(2, keepdims=True)
        prior = float(np.clip((post[:, 1].sum() + prior_good) / (counts.sum() + 1), 1e-6, 1 - 1e-6))
        if like - last < tolerance:
            break
        last = like
    return {"prior": prior, "table": table,
            "accuracy": prior * table[1, :, 1] + (1 - prior) * table[0, :, 0]}


def posterior(model: dict, codes) -> np.ndarray:
    """Probability of being good for each pattern."""
    labellers = model["table"].shape[1]
    votes = pattern_votes(np.asarray(codes, np.int64), labellers)
    lt = np.log(model["table"])
    seen = np.stack([votes == v for v in (0, 1)], -1)
    logs = np.einsum("pjv,cjv->pc", seen, lt)
    logs += np.log([1 - model["prior"], model["prior"]])
    return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))


def fit_frame(voted: DataFrame, pattern_col: str, labellers: int, **options) -> dict:
    """Fit from a table with a pattern column: one aggregate, 3^labellers counts."""
    if labellers > MAX_LABELLERS:
        raise ValueError(f"at most {MAX_LABELLERS} labellers, got {labellers}")
    rows = voted.groupBy(F.col(pattern_col).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    rows = sorted((r["p"], r["n"]) for r in rows)
    return fit([p for p, _ in rows], [n for _, n in rows], labellers, **options)


def posterior_frame(spark, model: dict, pattern_col: str, name: str = "posterior") -> DataFrame:
    """All patterns with their posterior: a table of 3^labellers rows."""
    codes = np.arange(3 ** model["table"].shape[1])
    p = posterior(model, codes)
    return spark.createDataFrame([(int(c), float(x)) for c, x in zip(codes, p)],
                                 f"{pattern_col} int, {name} double")
