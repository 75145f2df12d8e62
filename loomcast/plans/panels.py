"""Observation panels made from the given tables, each with its SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.operators.chunks import DAILY, HOURLY, POSITION, SeriesShape
from loomcast.operators.split import chronological_split, split_targets
from loomcast.operators.windows import add_targets
from loomcast.sources.readers import table

DAILY_HORIZONS = tuple(range(1, 6))
HOURLY_HORIZONS = tuple(range(1, 25))
SINGLE = SeriesShape(key=(), step=86400)


def hour_of(ts: str):
    return F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")


def day_of(ts: str):
    return F.col(ts).cast("date").cast("timestamp_ntz")


def hourly_panel(spark: SparkSession, folder: str, first: str | None = None, before: str | None = None) -> DataFrame:
    """Events by type and hour, of the hours from ``first`` on and before ``before``.

    The bounds are full hours; they hold for the raw time, so they reach the scan.
    """
    events = table(spark, folder, "events")
    for bound, inside in ((first, F.col("ts").__ge__), (before, F.col("ts").__lt__)):
        if bound is not None:
            events = events.where(inside(F.lit(bound).cast("timestamp_ntz")))
    return events.groupBy(F.col("event_type").alias("series_id"), hour_of("ts").alias("ts")).agg(
        F.avg("value").alias("temp"),
        F.max("value").alias("tempmax"),
        F.min("value").alias("tempmin"),
        F.count(F.lit(1)).cast("double").alias("precip"),
        F.count_distinct("user_id").cast("double").alias("humidity"),
        (F.max("value") - F.min("value")).alias("windspeed"),
        (1000 + F.avg("user_id")).alias("sealevelpressure"),
        (F.sum("user_id") % 360).cast("double").alias("winddir"),
    )


HOURLY_SQL = """h AS (
  SELECT event_type AS series_id, date_trunc('hour', ts) AS ts,
    avg(value) AS temp, max(value) AS tempmax, min(value) AS tempmin,
    count(*)::DOUBLE AS precip, count(DISTINCT user_id)::DOUBLE AS humidity,
    max(value) - min(value) AS windspeed, 1000 + avg(user_id) AS sealevelpressure,
    (sum(user_id) % 360)::DOUBLE AS winddir
  FROM events GROUP BY 1, 2)"""


def daily_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Line items by return flag and ship day."""
    items = table(spark, folder, "lineitem")
    code = F.sum("l_orderkey") % 4
    return items.groupBy(F.col("l_returnflag").alias("series_id"), day_of("l_shipdate").alias("ts")).agg(
        F.avg("l_quantity").alias("temp"),
        F.max("l_quantity").alias("tempmax"),
        F.min("l_quantity").alias("tempmin"),
        (100 * F.avg("l_discount")).alias("humidity"),
        (100 * F.avg("l_tax")).alias("windspeed"),
        F.avg("l_extendedprice").alias("sealevelpressure"),
        F.count(F.lit(1)).cast("double").alias("precip"),
        (F.sum("l_partkey") % 360).cast("double").alias("winddir"),
        F.max("l_linenumber").cast("double").alias("uvindex"),
        (100.0 * F.avg((F.col("l_linestatus") == "O").cast("int"))).alias("cloudcover"),
        F.avg("l_suppkey").alias("dew"),
        F.when(code == 0, "clear-day").when(code == 1, "rain").when(code == 2, "cloudy").alias("icon"),
    )


DAILY_SQL = """d AS (
  SELECT l_returnflag AS series_id, date_trunc('day', l_shipdate) AS ts,
    avg(l_quantity) AS temp, max(l_quantity) AS tempmax, min(l_quantity) AS tempmin,
    100 * avg(l_discount) AS humidity, 100 * avg(l_tax) AS windspeed,
    avg(l_extendedprice) AS sealevelpressure, count(*)::DOUBLE AS precip,
    (sum(l_partkey) % 360)::DOUBLE AS winddir, max(l_linenumber)::DOUBLE AS uvindex,
    100 * avg((l_linestatus = 'O')::INT) AS cloudcover, avg(l_suppkey) AS dew,
    CASE sum(l_orderkey) % 4 WHEN 0 THEN 'clear-day' WHEN 1 THEN 'rain' WHEN 2 THEN 'cloudy' END AS icon
  FROM lineitem GROUP BY 1, 2)"""


def single_series(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by day: one series without a key."""
    orders = table(spark, folder, "orders")
    return orders.groupBy(day_of("o_orderdate").alias("ts")).agg(
        F.avg("o_totalprice").alias("temp"), F.count(F.lit(1)).cast("double").alias("precip")
    )


SINGLE_SQL = """o AS (
  SELECT date_trunc('day', o_orderdate) AS ts, avg(o_totalprice) AS temp, count(*)::DOUBLE AS precip
  FROM orders GROUP BY 1)"""


def placed_sql(panel: str) -> str:
    """Position and split of every row of a keyed panel."""
    return f"""placed AS (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS pos,
    count(*) OVER (PARTITION BY series_id) AS series_rows FROM {panel}),
splits AS (
  SELECT *, CASE WHEN pos < floor(series_rows * 0.7::DOUBLE) THEN 'train'
    WHEN pos < floor(series_rows * 0.7::DOUBLE) + floor(series_rows * 0.15::DOUBLE) THEN 'dev'
    ELSE 'test' END AS split FROM placed)"""


def _narrow(panel: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return panel.select("series_id", "ts", *columns) if columns else panel


def hourly_splits(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Hourly panel, or some of its columns, with its chronological split."""
    return chronological_split(_narrow(hourly_panel(spark, folder), columns), HOURLY)


def daily_splits(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Daily panel, or some of its columns, with its chronological split."""
    return chronological_split(_narrow(daily_panel(spark, folder), columns), DAILY)


def target_pairs(df: DataFrame, shape: SeriesShape, horizons: tuple[int, ...], yhat: str = "temp") -> DataFrame:
    """Persistence forecast against later actuals, long by horizon; no label crosses a split.

    A panel without positions gets them, its split and its labels from one pass.
    """
    if POSITION in df.columns:
        wide = add_targets(df, shape, "temp", horizons, bounded_by="split")
    else:
        wide = split_targets(df, shape, "temp", horizons)
    pairs = [F.struct(F.lit(h).alias("horizon"), F.col(f"`target_temp_t+{h}`").alias("y")) for h in horizons]
    return wide.select("series_id", "ts", "split", F.col(yhat).alias("yhat"), F.inline(F.array(*pairs)))


def hourly_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of the hourly panel over 24 hours."""
    return target_pairs(_narrow(hourly_panel(spark, folder), ("temp",)), HOURLY, HOURLY_HORIZONS)


def daily_pairs(spark: SparkSession, folder: str, horizons: tuple[int, ...] = DAILY_HORIZONS) -> DataFrame:
    """Pairs of the daily panel."""
    return target_pairs(_narrow(daily_panel(spark, folder), ("temp",)), DAILY, horizons)


def pairs_sql(horizons: tuple[int, ...]) -> str:
    """SQL twin of ``target_pairs`` over ``splits``."""
    return f"""pairs AS (
  SELECT series_id, ts, split, temp AS yhat, horizon,
    lead(temp, horizon) OVER (PARTITION BY series_id, split, horizon ORDER BY ts) AS y
  FROM splits, (SELECT unnest(range({horizons[0]}, {horizons[-1] + 1}))::INT AS horizon))"""


METRICS_SQL = """metrics AS (
  SELECT horizon, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
    100 * avg(abs((y - yhat) / nullif(y, 0))) AS mape,
    1 - sum((y - yhat) * (y - yhat)) / (count(*) * var_pop(y)) AS r2, count(*) AS n_samples
  FROM pairs WHERE y IS NOT NULL AND yhat IS NOT NULL AND split = 'test' GROUP BY horizon)"""
