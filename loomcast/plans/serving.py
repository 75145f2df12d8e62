"""Tables behind the request surface: history, health, forecasts, details."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.functions.numeric import confidence_interval, display
from loomcast.functions.temporal import forecast_time, horizon_label, iso_text
from loomcast.functions.text import canonical_record
from loomcast.operators.filters import as_of, first_of_date
from loomcast.operators.topk import clamp_rows, latest_rows
from loomcast.sources.writers import export_envelope, export_records
from loomcast.spec import daily_spec, hourly_spec

# Fixed value: error assumed for a horizon without metrics.
FALLBACK_RMSE = 1.6
# Rows a forecast asks for: those behind its first complete feature row.
LEAST_DAYS = daily_spec().history_rows
LEAST_HOURS = hourly_spec().history_rows


def history(df: DataFrame, key: Sequence[str], ts: str, rows: int | None, cap: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Newest rows as records, and the envelope with their number, first and last time.

    ``cap`` is the limit of a service, if it has one; nothing is cut without it.
    """
    kept = latest_rows(df, key, ts, clamp_rows(rows, cap))
    return export_records(kept, key, ts), export_envelope(kept, key, ts)


def forecast_records(
    predictions: DataFrame, metrics: DataFrame, with_interval: bool = True, level: float = 0.95, ts: str = "forecast_ts"
) -> DataFrame:
    """Each prediction with display value, interval and the errors of its horizon.

    ``metrics`` holds one row per horizon.
    """
    joined = predictions.join(F.broadcast(metrics.select("horizon", "mae", "rmse", "mape", "r2")), "horizon", "left")
    temperature = display(F.col("yhat"))
    lower, upper = confidence_interval(temperature, F.coalesce("rmse", F.lit(FALLBACK_RMSE)), level)
    interval = F.struct(lower.alias("lower"), upper.alias("upper"), F.lit(level).alias("confidence_level"))
    performance = F.struct(
        display(F.col("rmse"), 2).alias("test_rmse"),
        display(F.col("mae"), 2).alias("test_mae"),
        display(F.col("r2"), 3).alias("test_r2"),
        display(F.col("mape"), 2).alias("test_mape"),
    )
    rest = [c for c in predictions.columns if c not in ("horizon", "yhat")]
    return joined.select(
        *rest,
        "horizon",
        temperature.alias("temperature"),
        F.lit("celsius").alias("unit"),
        (interval if with_interval else F.lit(None).cast("struct<lower:double,upper:double,confidence_level:double>")).alias("confidence_interval"),
        performance.alias("model_performance"),
    )


def forecast_response(records: DataFrame, key: Sequence[str], least_rows: int) -> DataFrame:
    """One nested row per series: its predictions in order of horizon, and the metadata."""
    prediction = F.struct("horizon", "target", iso_text(F.col("forecast_ts")).alias("forecast_ts"), "temperature", "unit", "confidence_interval", "model_performance")
    return records.groupBy(*key).agg(
        F.array_sort(F.collect_list(prediction)).alias("predictions"),
        F.struct(
            F.count(F.lit(1)).alias("total_predictions"),
            F.bround(F.avg("model_performance.test_r2"), 3).alias("average_confidence"),
            F.lit(least_rows).alias("minimum_rows"),
            iso_text(F.max("base_ts")).alias("latest_data"),
        ).alias("metadata"),
    )


def forecast_as_of(
    known: DataFrame,
    metrics: DataFrame,
    key: Sequence[str],
    reference: str,
    horizons: Sequence[int],
    unit: str,
    least_rows: int,
    ts: str = "ts",
    value: str = "temp",
) -> DataFrame:
    """Persistence reply of every series with ``least_rows`` rows up to a reference time.

    One aggregate gives the count and the newest row of a series; ``unit`` is HOUR or DAY.
    """
    newest = as_of(known, ts, reference).groupBy(*key).agg(
        F.count(F.lit(1)).alias("__have"), F.max(ts).alias("base_ts"), F.max_by(value, ts).alias("yhat")
    ).where(F.col("__have") >= least_rows)
    steps = newest.select(*key, "base_ts", "yhat", F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon"))
    named = {
        "target": horizon_label(F.col("horizon"), "h" if unit == "HOUR" else ""),
        "forecast_ts": forecast_time(F.col("base_ts"), F.col("horizon"), unit),
    }
    return forecast_response(forecast_records(steps.withColumns(named), metrics), key, least_rows)


def details(df: DataFrame, key: Sequence[str], ts: str, day: str, keys: Sequence[str]) -> DataFrame:
    """First record of a date with fixed keys and without temperatures; no row where there is none."""
    row = first_of_date(df, key, ts, day)
    return row.select(*key, ts, canonical_record(row, keys).alias("details"))
