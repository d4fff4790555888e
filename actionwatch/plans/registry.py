"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Table = Callable[[str], DataFrame]
QUERIES: dict[str, Callable[[Table], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(t)``, where ``t(name)`` reads a table; ``sql`` is the same query for the oracle."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def bound(f: Callable[[Table], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

    return run
