"""Scans of observation files, split tables and metric files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcast.functions.numeric import finite_frame
from loomcast.functions.temporal import horizon_number
from loomcast.operators.dedup import keep_first
from loomcast.sources import schemas


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_observations(spark: SparkSession, path: str, schema: T.StructType, series: str = "name") -> DataFrame:
    """CSV observations as ``(series_id, ts, ...)``: text time parsed, NaN and infinities to null."""
    raw = spark.read.schema(schema).option("header", True).csv(path)
    timed = raw.withColumns({"series_id": F.col(series), "ts": F.col("datetime").cast("timestamp_ntz")})
    rest = [c for c in raw.columns if c not in ("datetime", series)]
    return finite_frame(timed.select("series_id", "ts", *rest))


def first_per_time(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per ``(series_id, ts)``, the first in the given order."""
    return keep_first(df, ["series_id", "ts"], order)


def time_range(df: DataFrame, ts: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Half-open range on the time column; it reaches the scan as a pushed filter."""
    out = df
    if start:
        out = out.where(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if end:
        out = out.where(F.col(ts) < F.lit(end).cast("timestamp_ntz"))
    return out


def feature_contract(df: DataFrame, outside: Sequence[str]) -> list[str]:
    """Feature order a model expects, from the schema alone."""
    return [c for c in df.columns if c not in outside]


def read_split(spark: SparkSession, path: str, split: str, horizon: int | None = None) -> DataFrame:
    """One split (and one horizon): other partitions of the table are not read."""
    out = spark.read.parquet(path).where(F.col("split") == split)
    return out if horizon is None else out.where(F.col("horizon") == horizon)


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """Nested metrics (map keyed by horizon) to rows."""
    nested = spark.read.schema(schemas.HOURLY_METRICS).option("multiLine", True).json(path)
    rows = nested.select(F.explode("per_hour_metrics").alias("target", "entry"))
    return rows.select("target", F.col("entry.hour").alias("hour"), "entry.metrics.*")


def read_tuning_json(spark: SparkSession, path: str) -> DataFrame:
    """Tuning results ``{horizon: {model, params, ...}}`` to rows."""
    text = spark.read.text(path, wholetext=True)
    parsed = text.select(F.from_json("value", T.MapType(T.StringType(), schemas.TUNING_RESULT)).alias("m"))
    rows = parsed.select(F.explode("m").alias("target", "entry"))
    return rows.select(horizon_number(F.col("target")).alias("horizon"), "target", "entry.*")


def read_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DAILY_METRICS_CSV).option("header", True).csv(path)
