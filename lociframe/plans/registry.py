"""Registered queries and their SQL oracles."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lociframe.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its DuckDB form where SQL can express it."""

    def add(f):
        @functools.wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


from lociframe.plans import interval_queries, read_queries, region_queries, report_queries, variant_queries  # noqa: E402, F401
