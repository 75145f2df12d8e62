"""Declared schemas of observation files and result tables."""

from __future__ import annotations

from pyspark.sql import types as T

_D, _S, _I = T.DoubleType(), T.StringType(), T.IntegerType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Measures are doubles throughout: whole numbers in one file must not change the type.
HOURLY_OBSERVATIONS = _schema(
    ("name", _S), ("datetime", _S), ("temp", _D), ("feelslike", _D), ("dew", _D), ("humidity", _D),
    ("precip", _D), ("precipprob", _D), ("preciptype", _S), ("snow", _D), ("snowdepth", _D),
    ("windgust", _D), ("windspeed", _D), ("winddir", _D), ("sealevelpressure", _D), ("cloudcover", _D),
    ("visibility", _D), ("solarradiation", _D), ("solarenergy", _D), ("uvindex", _D), ("severerisk", _D),
    ("conditions", _S), ("icon", _S), ("stations", _S),
)

DAILY_OBSERVATIONS = _schema(
    ("name", _S), ("datetime", _S), ("tempmax", _D), ("tempmin", _D), ("temp", _D), ("feelslikemax", _D),
    ("feelslikemin", _D), ("feelslike", _D), ("dew", _D), ("humidity", _D), ("precip", _D),
    ("precipprob", _D), ("precipcover", _D), ("preciptype", _S), ("snow", _D), ("snowdepth", _D),
    ("windgust", _D), ("windspeed", _D), ("winddir", _D), ("sealevelpressure", _D), ("cloudcover", _D),
    ("visibility", _D), ("solarradiation", _D), ("solarenergy", _D), ("uvindex", _D), ("severerisk", _D),
    ("sunrise", _S), ("sunset", _S), ("moonphase", _D), ("conditions", _S), ("description", _S),
    ("icon", _S), ("stations", _S), ("source", _S),
)

METRIC_VALUES = _schema(("MAE", _D), ("RMSE", _D), ("MAPE", _D), ("R2", _D))

HOURLY_METRICS = _schema(
    ("average_metrics", METRIC_VALUES),
    ("per_hour_metrics", T.MapType(_S, _schema(("hour", _I), ("metrics", METRIC_VALUES)))),
)

DAILY_METRICS_CSV = _schema(("target", _S), ("MAE", _D), ("RMSE", _D), ("MAPE", _D), ("R2", _D), ("n_samples", _I))

TUNING_RESULT = _schema(
    ("model", _S), ("n_features", _I), ("params", T.MapType(_S, _S)), ("best_rmse", _D)
)

EVENTS = _schema(
    ("event_id", T.LongType()), ("ts", T.TimestampNTZType()), ("user_id", T.LongType()),
    ("event_type", _S), ("value", _D), ("props", _S),
)
