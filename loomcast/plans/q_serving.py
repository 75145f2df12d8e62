"""Queries behind the request surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.functions.text import HOURLY_RECORD_KEYS
from loomcast.functions.temporal import forecast_time, horizon_label
from loomcast.operators.chunks import DAILY
from loomcast.operators.dedup import last_rows
from loomcast.operators.filters import series_with_history
from loomcast.operators.metrics import forecast_metrics
from loomcast.plans import serving
from loomcast.plans.catalog import query
from loomcast.plans.panels import (
    DAILY_HORIZONS, DAILY_SQL, HOURLY_HORIZONS, HOURLY_SQL, METRICS_SQL,
    daily_splits, hourly_pairs, hourly_panel, pairs_sql, placed_sql, target_pairs,
)
from loomcast.session import settled


@query(
    "serve_history_envelope",
    f"""WITH {HOURLY_SQL}, k AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) <= 72)
SELECT series_id, count(*) AS total_records, strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS start, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS "end" FROM k GROUP BY 1""",
)
def history_envelope(spark, folder):
    _, envelope = serving.history(hourly_panel(spark, folder).select("series_id", "ts", "precip"), ["series_id"], "ts", 72)
    return envelope


@query(
    "serve_daily_forecast",
    f"""WITH {DAILY_SQL}, {placed_sql('d')}, {pairs_sql(DAILY_HORIZONS)}, {METRICS_SQL},
n AS (SELECT series_id, max(ts) AS ts, max_by(temp, ts) AS temp, any_value(series_rows) AS series_rows FROM splits GROUP BY 1)
SELECT series_id, horizon, 't+' || horizon AS target, strftime(ts + to_days(horizon), '%Y-%m-%dT%H:%M:%S') AS forecast_ts,
  round_even(temp, 1) + 0.0 AS temperature, round_even(round_even(temp, 1) - 1.96 * rmse, 1) + 0.0 AS lower,
  round_even(round_even(temp, 1) + 1.96 * rmse, 1) + 0.0 AS upper, round_even(rmse, 2) + 0.0 AS test_rmse, 5 AS total_predictions
FROM n, metrics WHERE series_rows >= {serving.LEAST_DAYS}""",
)
def daily_forecast(spark, folder):
    """Persistence forecast of each series as the nested response, unpacked again."""
    splits = settled(daily_splits(spark, folder, "temp"), "splits")
    metrics = forecast_metrics(target_pairs(splits, DAILY, DAILY_HORIZONS).where("split = 'test'"))
    newest = last_rows(series_with_history(splits, ["series_id"], serving.LEAST_DAYS).select("series_id", "ts", "temp"), ["series_id"], "ts")
    steps = newest.select("series_id", F.col("ts").alias("base_ts"), F.col("temp").alias("yhat"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("horizon"))
    made = steps.withColumns({"target": horizon_label(F.col("horizon")), "forecast_ts": forecast_time(F.col("base_ts"), F.col("horizon"), "DAY")})
    response = serving.forecast_response(serving.forecast_records(made, metrics), ["series_id"], serving.LEAST_DAYS)
    rows = response.select("series_id", F.col("metadata.total_predictions").cast("int").alias("total_predictions"), F.inline("predictions"))
    return rows.select(
        "series_id", "horizon", "target", "forecast_ts", "temperature", "confidence_interval.lower", "confidence_interval.upper",
        "model_performance.test_rmse", "total_predictions",
    )


# Fixed value: the hour a request asks forecasts for.
REFERENCE = "2024-01-20 12:00:00"


@query(
    "serve_hourly_forecast",
    f"""WITH {HOURLY_SQL}, {placed_sql('h')}, {pairs_sql(HOURLY_HORIZONS)}, {METRICS_SQL},
n AS (SELECT series_id, max(ts) AS ts, max_by(temp, ts) AS temp, count(*) AS have FROM h WHERE ts <= TIMESTAMP '{REFERENCE}' GROUP BY 1)
SELECT series_id, horizon, 't+' || horizon || 'h' AS target, strftime(ts + to_hours(horizon), '%Y-%m-%dT%H:%M:%S') AS forecast_ts,
  round_even(temp, 1) + 0.0 AS temperature, round_even(round_even(temp, 1) - 1.96 * rmse, 1) + 0.0 AS lower,
  round_even(round_even(temp, 1) + 1.96 * rmse, 1) + 0.0 AS upper, round_even(rmse, 2) + 0.0 AS test_rmse, 24 AS total_predictions,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS latest_data
FROM n, metrics WHERE have >= {serving.LEAST_HOURS}""",
)
def hourly_forecast(spark, folder):
    """The next 24 hours of each series as known at a reference time, with intervals."""
    metrics = forecast_metrics(hourly_pairs(spark, folder).where("split = 'test'"))
    known = hourly_panel(spark, folder, before="2024-01-20 13:00:00").select("series_id", "ts", "temp")
    response = serving.forecast_as_of(known, metrics, ["series_id"], REFERENCE, HOURLY_HORIZONS, "HOUR", serving.LEAST_HOURS)
    rows = response.select(
        "series_id", F.col("metadata.total_predictions").cast("int").alias("total_predictions"),
        F.col("metadata.latest_data").alias("latest_data"), F.inline("predictions"),
    )
    return rows.select(
        "series_id", "horizon", "target", "forecast_ts", "temperature", "confidence_interval.lower", "confidence_interval.upper",
        "model_performance.test_rmse", "total_predictions", "latest_data",
    )


@query(
    "serve_details",
    f"""WITH {HOURLY_SQL}, f AS (SELECT series_id, min(ts) AS ts, min_by(humidity, ts) AS humidity, min_by(precip, ts) AS precip, min_by(winddir, ts) AS winddir
  FROM h WHERE ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-21' GROUP BY 1)
SELECT series_id, ts, to_json({{'conditions': NULL, 'humidity': humidity, 'precip': precip, 'precipprob': NULL, 'preciptype': NULL, 'windspeed': NULL,
  'winddir': winddir, 'windgust': NULL, 'dew': NULL, 'cloudcover': NULL, 'uvindex': NULL, 'visibility': NULL, 'confidence': NULL, 'icon': NULL}})::VARCHAR AS details FROM f""",
)
def details(spark, folder):
    panel = hourly_panel(spark, folder, "2024-01-20", "2024-01-21").select("series_id", "ts", "temp", "humidity", "precip", "winddir")
    return serving.details(panel, ["series_id"], "ts", "2024-01-20", HOURLY_RECORD_KEYS)
