"""Query registry: name -> (Spark callable, optional oracle SQL).

Queries take ``(spark, sf_dir)`` and return a DataFrame.  The oracle is the
same computation in DuckDB SQL over the raw tables; queries whose semantics
SQL cannot express (difflib, stateful streams writing files) register none.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from vqaspark.plans import (  # noqa: F401
        q_data, q_joins, q_predict, q_metrics, q_runs, q_stream, q_files)
