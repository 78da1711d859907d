"""The registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import Fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of the derived tables as a query, with the DuckDB SQL that must give the same rows."""
    def register(f: Callable[[Fixtures], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Fixtures(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return f
    return register
