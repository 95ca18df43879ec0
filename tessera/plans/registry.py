"""Registry of named queries over the test tables and their SQL oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame``.  ``sql`` is an equivalent
DuckDB query over the views ``region nation customer supplier part orders
lineitem events documents embeddings pages benchmark labels conversations``
(None when the job is iterative/randomised beyond SQL; those are checked by
row counts and invariant tests instead).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DOCS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        DOCS[name] = (fn.__doc__ or "").strip()
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all() -> None:
    """Import every query module so the registry is filled."""
    from tessera.plans import (q_bandit, q_cluster, q_linear, q_lsh, q_select,  # noqa: F401
                               q_stream, q_vector_lsh)
