"""Where the queries are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.views import Data, duckdb_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, materialized: bool = False):
    """Register a function from :class:`Data` to DataFrame, and the SQL giving the same rows.

    ``materialized`` lets DuckDB compute each view once, whatever plan it picks.
    """

    def register(build: Callable[[Data], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Data(spark, folder))
        if sql is not None:
            ORACLES[name] = duckdb_sql(sql, materialized)
        return build

    return register
