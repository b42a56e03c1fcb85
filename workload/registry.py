"""Registry of queries and the SQL each is checked against."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricepanel.session import scratch, ship  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL if SQL can express it."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)  # the queries are started from any folder
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def r6(c: Column | str, alias: str | None = None) -> Column:
    """Rounded to 6 decimals, the precision both engines agree on for computed doubles."""
    name = alias or (c if isinstance(c, str) else None)
    col = F.round(F.col(c) if isinstance(c, str) else c, 6)
    return col.alias(name) if name else col


def q6(expr: str) -> str:
    return f"(round({expr}, 6) + 0)"


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})
