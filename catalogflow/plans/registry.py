"""Registered queries: name -> Spark callable, and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.plans.standins import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is left out where SQL cannot express it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql, *views)
        return fn

    return register


def r6(value: Column | str, name: str | None = None, digits: int = 6) -> Column:
    """Six decimals, without a negative zero."""
    column = F.col(value) if isinstance(value, str) else value
    rounded = F.round(column.cast("double"), digits) + F.lit(0.0)
    return rounded.alias(name or (value if isinstance(value, str) else "value"))


def s6(expression: str, name: str | None = None, digits: int = 6) -> str:
    return f"round(CAST({expression} AS DOUBLE), {digits}) + 0.0::DOUBLE AS {name or expression}"


def spread(vector: Column, n: int, prefix: str) -> list[Column]:
    """A vector as rounded columns, so that every engine compares it alike."""
    return [r6(F.get(vector, F.lit(i)), f"{prefix}_{i}") for i in range(n)]


def s_spread(vector: str, n: int, prefix: str) -> str:
    return ", ".join(s6(f"{vector}[{i + 1}]", f"{prefix}_{i}") for i in range(n))
