"""Records as JSON text and replies of a text model cleaned to records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Temperature fields that never leave in a details record.
MASKED_FIELDS = ("temp", "tempmin", "tempmax", "temperature")

# Keys of the daily and of the hourly details record.
DAILY_RECORD_KEYS = (
    "conditions", "humidity", "precip", "precipprob", "preciptype", "windspeed", "winddir", "windgust",
    "sunrise", "sunset", "uvindex", "visibility", "cloudcover", "moonphase", "dew", "sealevelpressure",
)
HOURLY_RECORD_KEYS = (
    "conditions", "humidity", "precip", "precipprob", "preciptype", "windspeed", "winddir", "windgust",
    "dew", "cloudcover", "uvindex", "visibility", "confidence", "icon",
)


def masked_record(df: DataFrame, masked: Sequence[str] = MASKED_FIELDS) -> Column:
    """All columns but the masked ones as one JSON text."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns if c not in masked]))


def canonical_record(df: DataFrame, keys: Sequence[str]) -> Column:
    """JSON text with exactly these keys in this order; absent columns and nulls stay as null."""
    fields = [F.col(k) if k in df.columns else F.lit(None).cast("string").alias(k) for k in keys]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def strip_code_fence(reply: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(reply, "```(json)?", ""), r"^\s+|\s+$", "")


def parse_reply(reply: Column) -> Column:
    """Object text of a reply, else an object that keeps the reply under ``raw``."""
    text = strip_code_fence(reply)
    parsed = F.try_parse_json(text)
    is_object = text.startswith("{") & parsed.isNotNull()
    raw = F.to_json(F.struct(F.when(parsed.isNull(), reply).otherwise(text).alias("raw")))
    return F.when(is_object, F.to_json(parsed)).otherwise(raw)
