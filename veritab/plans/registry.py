"""All registered queries over the driver's tables, with their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from veritab.shipping import ship

MODULES = ("queries_scores", "queries_corpus", "queries_sources", "queries_rules", "queries_flows")
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with the SQL that gives the same rows."""

    def add(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return add


def _load() -> None:
    """Import the modules that register queries."""
    for name in MODULES:
        import_module(f"veritab.plans.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def oracle_of(name: str) -> str:
    """SQL of a query that has been registered already."""
    return _ORACLES[name]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which records are safe to publish, and why each other one was denied."""
    return queries()["gate_decision"](spark, sf_dir)
