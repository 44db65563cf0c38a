"""Deterministic, partitioning-independent hash keys.

``rand(seed)`` depends on how rows are spread over partitions, so a shuffle or
split made with it changes when the cluster or file layout changes.  Keys made
from ``md5(seed:id)`` depend on the row alone: the same row always lands in
the same place, and adding rows never moves existing ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shuffle_key(id_col, seed: int = 42) -> Column:
    """32-hex-char md5 of ``'<seed>:<id>'``; ordering by it is a seeded shuffle."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _c(id_col).cast("string")))


def hash_bucket(id_col, seed: int = 42, buckets: int = 100) -> Column:
    """First 8 hex digits of the shuffle key as an integer, modulo ``buckets``."""
    head = F.substring(shuffle_key(id_col, seed), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % F.lit(buckets)).cast("bigint")


HASH_RANGE = 1 << 32


def hash_value(id_col, seed: int = 42) -> Column:
    """First 8 hex digits of the shuffle key as an integer below 2^32."""
    return F.conv(F.substring(shuffle_key(id_col, seed), 1, 8), 16, 10).cast("bigint")


def hash_choice(id_col, fractions, names, seed: int = 42) -> Column:
    """One of ``names`` with the given ``fractions``: the full 32-bit hash is
    compared with ``fraction * 2^32``, so fractions of any fineness hold."""
    from math import ceil
    h, expr, edge = hash_value(id_col, seed), None, 0.0
    for frac, name in zip(fractions[:-1], names[:-1]):
        edge += frac
        cond = h < F.lit(ceil(round(edge * HASH_RANGE, 3)))
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return F.lit(names[-1]) if expr is None else expr.otherwise(names[-1])
