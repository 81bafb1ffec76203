"""Collects the registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from duolect.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL that must give the same rows."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return query(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register
