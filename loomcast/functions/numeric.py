"""Numeric column functions: clean values, clipping, scaling, intervals, curves."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Z scores at 95 % and at 99 % confidence.
Z_95 = 1.96
Z_99 = 2.576

# Fixed value: hour at which the synthetic daily curve crosses its mean upwards.
CURVE_HOUR = 14


def finite(value: Column) -> Column:
    """NaN and infinities become null."""
    bad = F.isnan(value) | value.isin(float("inf"), float("-inf"))
    return F.when(~bad, value)


def finite_frame(df: DataFrame) -> DataFrame:
    """``finite`` on every floating-point column."""
    return df.select(
        *[
            finite(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def impute_and_clip(value: Column, centre: Column, lower: Column, upper: Column) -> Column:
    """Fill first: ``greatest`` and ``least`` would skip a null."""
    return F.greatest(F.least(F.coalesce(value, centre), upper), lower)


def standardise(value: Column, mean: Column, std: Column) -> Column:
    return (value - mean) / F.when(std == 0, F.lit(1.0)).otherwise(std)


def confidence_interval(value: Column, rmse: Column, level: float = 0.95) -> tuple[Column, Column]:
    margin = F.lit(Z_95 if level == 0.95 else Z_99) * rmse
    return display(value - margin), display(value + margin)


def display(value: Column, digits: int = 1) -> Column:
    """Round for display, ties to even."""
    return F.bround(value, digits)


def diurnal_curve(low: Column, high: Column, hour: Column) -> Column:
    """Hourly value of a sine between a day's minimum and maximum; it is at its mean at 14 h."""
    amplitude = F.when(high > low, (high - low) / 2).otherwise(F.lit(1.0))
    return (high + low) / 2 + amplitude * F.sin((hour - CURVE_HOUR) / 24 * F.lit(2 * math.pi))


def interactions(columns: Sequence[str]) -> dict[str, Column]:
    """Products whose inputs are all among ``columns``."""
    products = {
        "windspeed_sq": ("windspeed", "windspeed"),
        "pressure_humidity": ("sealevelpressure", "humidity"),
        "daylength_uv": ("day_length_h", "uvindex"),
    }
    return _products(products, columns)


def exploratory_interactions(columns: Sequence[str]) -> dict[str, Column]:
    products = {
        "feelslike_humidity_int": ("feelslikemax", "humidity"),
        "windchill_int": ("feelslikemin", "windspeed"),
    }
    return _products(products, columns)


def _products(products: dict[str, tuple[str, str]], columns: Sequence[str]) -> dict[str, Column]:
    known = set(columns)
    return {name: F.col(a) * F.col(b) for name, (a, b) in products.items() if {a, b} <= known}
