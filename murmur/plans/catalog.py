"""Registry of named queries: id -> (spark, sf_dir) -> DataFrame, plus the DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query id {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    # importing the modules registers their queries
    from murmur.plans import q_relational, q_windows, q_enrich, q_io, q_ml, q_stream, q_jobs  # noqa: F401
