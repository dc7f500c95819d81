"""Registry of the queries: a callable over the driver tables and, where SQL can say it, the same in ANSI SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r6(c: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison; adding zero turns a negative zero into zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def q6(expression: str, digits: int = 6) -> str:
    """SQL twin of :func:`r6`."""
    return f"(round({expression}, {digits}) + 0.0)"
