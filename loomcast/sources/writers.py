"""Sinks: split tables, rankings, metrics, run logs and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.functions.numeric import finite_frame
from loomcast.functions.temporal import iso_text


def write_split_tables(df: DataFrame, path: str, partitions: Sequence[str] = ("split",)) -> None:
    """Partitioned Parquet; rebalancing gathers small partitions and cuts large ones."""
    df.hint("rebalance", *partitions).write.partitionBy(*partitions).mode("overwrite").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a log table (tuning results, training metadata, trials)."""
    df.write.mode("append").parquet(path)


def metric_struct() -> Column:
    return F.struct(F.col("mae").alias("MAE"), F.col("rmse").alias("RMSE"), F.col("mape").alias("MAPE"), F.col("r2").alias("R2"))


def nested_metrics(metrics: DataFrame, unit: str = "h") -> DataFrame:
    """One row: the averages and a map keyed by horizon (one small entry per horizon)."""
    label = F.concat(F.lit("t+"), F.col("horizon").cast("string"), F.lit(unit))
    entry = F.struct(F.col("horizon").cast("int").alias("hour"), metric_struct().alias("metrics"))
    mean = F.struct(*[F.avg(c).alias(n) for c, n in (("mae", "MAE"), ("rmse", "RMSE"), ("mape", "MAPE"), ("r2", "R2"))])
    return metrics.agg(
        mean.alias("average_metrics"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(label, entry)))).alias("per_hour_metrics"),
    )


def write_metrics(metrics: DataFrame, json_path: str, table_path: str, unit: str = "h") -> None:
    nested_metrics(metrics, unit).write.mode("overwrite").json(json_path)
    write_table(metrics, table_path)


def write_metrics_csv(metrics: DataFrame, path: str, unit: str = "") -> None:
    label = F.concat(F.lit("t+"), F.col("horizon").cast("string"), F.lit(unit)).alias("target")
    flat = metrics.select(label, *[F.col(c).alias(n) for c, n in (("mae", "MAE"), ("rmse", "RMSE"), ("mape", "MAPE"), ("r2", "R2"))], F.col("n_samples").cast("int"))
    flat.write.mode("overwrite").option("header", True).csv(path)


def export_records(df: DataFrame, key: Sequence[str], ts: str) -> DataFrame:
    """``(key..., time text, record)``: ISO time, non-finite values null, the row as JSON."""
    clean = finite_frame(df).withColumn(ts, iso_text(F.col(ts)))
    record = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    return clean.select(*key, ts, record.alias("record"))


def export_envelope(df: DataFrame, key: Sequence[str], ts: str) -> DataFrame:
    """Record count and first / last time per series."""
    return df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("total_records"),
        iso_text(F.min(ts)).alias("start"),
        iso_text(F.max(ts)).alias("end"),
    )
