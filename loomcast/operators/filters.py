"""Projections and filters over observation tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.functions.temporal import date_range, year_range
from loomcast.operators.chunks import null_safe_join

NUMERIC_KINDS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def columns_of_kind(df: DataFrame, numeric: bool) -> list[str]:
    """Names of the numeric (or of the text) columns."""
    if numeric:
        return [n for n, kind in df.dtypes if kind in NUMERIC_KINDS or kind.startswith("decimal")]
    return [n for n, kind in df.dtypes if kind == "string"]


def filled_columns(train: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at least one value in the training rows; one aggregate, one row."""
    counts = train.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c] > 0]


def drop_empty_columns(df: DataFrame, columns: Sequence[str], train: Column) -> DataFrame:
    kept = set(filled_columns(df.where(train), columns))
    return df.drop(*[c for c in columns if c not in kept])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(column_name, nulls, all_null)``."""
    total = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), (F.col("__n") - F.col(c)).alias("nulls"), (F.col(c) == 0).alias("all_null")) for c in columns]
    return total.select(F.inline(F.array(*pairs)))


def as_of(df: DataFrame, ts: str, reference: str) -> DataFrame:
    return df.where(F.col(ts) <= F.lit(reference).cast("timestamp_ntz"))


def series_with_history(df: DataFrame, key: Sequence[str], rows: int) -> DataFrame:
    """Keep the series that hold at least ``rows`` rows.

    The counts are one row per series; the rows themselves are not gathered by series.
    """
    enough = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= rows).select(*key)
    return null_safe_join(df, enough, list(key), "left_semi")


def history_filter(
    df: DataFrame,
    ts: str,
    first: str | None = None,
    last: str | None = None,
    month_name: str | None = None,
    year: int | None = None,
) -> DataFrame:
    """Inclusive dates, month name and year, all of which must hold."""
    out = df.where(date_range(F.col(ts), first, last))
    if year is not None:
        out = out.where(year_range(F.col(ts), year))
    if month_name is not None:
        out = out.where(F.date_format(F.col(ts), "MMMM") == month_name)
    return out


def first_of_date(df: DataFrame, key: Sequence[str], ts: str, day: str, last: bool = False) -> DataFrame:
    """First (or last) row of a date per series."""
    rows = df.where(date_range(F.col(ts), day, day))
    pick = F.max_by if last else F.min_by
    record = pick(F.struct(*[F.col(c) for c in df.columns]), F.col(ts)).alias("r")
    return rows.groupBy(*key).agg(record).select("r.*") if key else rows.agg(record).where("r IS NOT NULL").select("r.*")


def lookup_time(requests: DataFrame, stored: DataFrame, key: Sequence[str], ts: str, value: str) -> DataFrame:
    """Value at the requested time, else the first one in the same minute.

    Both lookup tables hold one row per key, so no request meets more than one row of each.
    """
    exact = stored.groupBy(*key, ts).agg(F.min(value).alias("__exact"))
    minute = stored.groupBy(*key, F.date_trunc("minute", F.col(ts)).cast("timestamp_ntz").alias("__minute")).agg(
        F.min_by(value, F.struct(ts, value)).alias("__near")
    )
    asked = requests.withColumn("__minute", F.date_trunc("minute", F.col(ts)).cast("timestamp_ntz"))
    found = asked.join(exact, [*key, ts], "left").join(minute, [*key, "__minute"], "left")
    return found.select(
        *requests.columns,
        F.coalesce("__exact", "__near").alias(f"found_{value}"),
        F.col("__exact").isNotNull().alias("exact"),
    )
