"""Additive decomposition into trend, season and residual."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.operators.chunks import LENGTH, POSITION, SeriesShape, null_safe_join, over_chunks
from loomcast.operators.windows import centred_mean
from loomcast.session import settled


def decompose(df: DataFrame, shape: SeriesShape, column: str = "temp", period: int = 7) -> DataFrame:
    """Add ``trend``, ``seasonal`` and ``resid``; series shorter than two periods are left out."""
    key = list(shape.key)
    half = period // 2
    known = df.where(F.col(column).isNotNull())
    placed = over_chunks(
        known, shape, lambda w: [centred_mean(w, column, period).alias("trend")], back=half, ahead=half, numbered=True
    )
    windowed = placed.where(F.col(LENGTH) >= 2 * period).withColumn("phase", (F.col(POSITION) % period).cast("int"))
    # Read twice, for the phase means and for the rows: written once instead of windowed twice.
    trended = settled(windowed, "trend")
    seasonal = phase_means(trended, key, column, period)
    # A few rows per series; the join key keeps series and phase apart, and adaptive execution
    # broadcasts the means or cuts a series that is too large for one task.
    joined = null_safe_join(trended, seasonal, [*key, "phase"])
    return joined.withColumn("resid", F.col(column) - F.col("trend") - F.col("seasonal"))


def phase_means(trended: DataFrame, key: list[str], column: str, period: int) -> DataFrame:
    """Mean detrended value of each phase less the mean over the phases: ``period`` rows a series."""
    means = trended.groupBy(*key, "phase").agg(F.avg(F.col(column) - F.col("trend")).alias("m"))
    gathered = means.groupBy(*key).agg(F.avg("m").alias("centre"), F.collect_list(F.struct("phase", "m")).alias("ms"))
    return gathered.select(*key, "centre", F.inline("ms")).select(*key, "phase", (F.col("m") - F.col("centre")).alias("seasonal"))
