"""Newest, first and best n rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def clamp_rows(asked: int | None, cap: int | None = None) -> int | None:
    """Rows to return: at least 1, at most a ``cap`` that the caller sets; nothing asked means all."""
    return None if asked is None else max(1, asked if cap is None else min(asked, cap))


def first_rows(df: DataFrame, key: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows of each series; each task cuts to ``n`` per series before the shuffle."""
    if not key:
        return df.orderBy(*order).limit(n)
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col("__rn") <= n).drop("__rn")


def latest_rows(df: DataFrame, key: Sequence[str], ts: str, n: int | None) -> DataFrame:
    """Newest ``n`` rows of each series, or all."""
    return df if n is None else first_rows(df, key, [F.col(ts).desc()], n)


def rows_from(df: DataFrame, key: Sequence[str], ts: str, start: str, n: int) -> DataFrame:
    """First ``n`` rows from a time on."""
    return first_rows(df.where(F.col(ts) >= F.lit(start).cast("timestamp_ntz")), key, [F.col(ts)], n)


def time_ordered_layout(df: DataFrame, ts: str) -> DataFrame:
    """Range partitions, sorted inside: the layout of a table written in time order."""
    return df.repartitionByRange(ts).sortWithinPartitions(ts)
