"""Registry of queries and of the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows are checked by the driver."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepare(spark), folder)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


# Exact ties such as 0.0000005 round up in one engine and down in another; a fixed offset far
# below the last digit shown takes them off the edge on both sides.
OFF_EDGE = 0.37e-3


def rnd(column: str | Column, digits: int = 6) -> Column:
    """Rounded value: float sums depend on their order in the last digits."""
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value + F.lit(OFF_EDGE * 10.0**-digits), digits)


def rounded(column: str, digits: int = 6) -> Column:
    """``rnd`` of a column under its own name."""
    return rnd(column, digits).alias(column)


def r(expression: str, digits: int = 6) -> str:
    """SQL twin of ``rnd``; adding 0.0 turns a negative zero into zero."""
    return f"(round({expression} + {OFF_EDGE * 10.0**-digits!r}::DOUBLE, {digits}) + 0.0)"


def rr(names: str, digits: int = 6) -> str:
    """``r`` for a list of plain columns."""
    return ", ".join(f"{r(n, digits)} AS {n}" for n in names.split())
