"""Duplicates, newest rows and new rows.

Every choice of one row per key is an aggregate with a struct order, so a key that holds a
large share of the table is reduced before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.operators.chunks import null_safe_join


def _pick(df: DataFrame, key: Sequence[str], choose, order: Column) -> DataFrame:
    record = choose(F.struct(*[F.col(c) for c in df.columns]), order).alias("r")
    return df.groupBy(*key).agg(record).select("r.*")


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, key, F.min_by, F.struct(*order))


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, key, F.max_by, F.struct(*order))


def merge_history_and_forecast(
    history: DataFrame, forecast: DataFrame, key: Sequence[str], issued: str | None = None
) -> DataFrame:
    """Union by name with missing columns as null; the forecast wins where both know a time.

    Of several forecasts of one time the one ``issued`` last wins, where that column is given.
    """
    both = history.unionByName(forecast, allowMissingColumns=True)
    return keep_last(both, key, ["is_forecast", *([issued] if issued else [])])


def last_rows(df: DataFrame, key: Sequence[str], ts: str) -> DataFrame:
    """Newest row of each series, the origin of a forecast."""
    return keep_last(df, key, [ts])


def only_new(incoming: DataFrame, stored: DataFrame, key: Sequence[str]) -> DataFrame:
    return null_safe_join(incoming, stored.select(*key), list(key), "left_anti")
