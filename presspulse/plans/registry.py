"""Registry of named queries and the SQL that states the same result independently."""

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


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Final rounding of a computed double, with one zero only."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def round_all(*names: str, digits: int = 6) -> list[Column]:
    return [rounded(n, digits).alias(n) for n in names]
