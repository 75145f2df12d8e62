"""Regular calendar grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.operators.chunks import SeriesShape, null_safe_join

# Longest run of grid points made from one row at a time.
RUN = 1000


def densify(df: DataFrame, shape: SeriesShape) -> DataFrame:
    """One row per step from the first to the last time of a series; gaps hold nulls.

    Every given row stays, those of a missing key, off the grid or without a time among them.
    Where all times lie on the grid, a lag of k rows is a lag of k steps afterwards.
    """
    key, ts = list(shape.key), shape.ts
    step = F.make_dt_interval(secs=F.lit(shape.step))
    run = F.make_dt_interval(secs=F.lit(shape.step * RUN))
    ends = df.groupBy(*key).agg(F.min(ts).alias("__a"), F.max(ts).alias("__z"))
    runs = ends.select(*key, "__z", F.explode(F.sequence("__a", "__z", run)).alias("__from"))
    stop = F.least(F.col("__from") + F.make_dt_interval(secs=F.lit(shape.step * (RUN - 1))), F.col("__z"))
    # The runs of one long series go to many tasks before they are expanded.
    grid = runs.repartition(*key, "__from").select(*key, F.explode(F.sequence("__from", stop, step)).alias(ts))
    gaps = null_safe_join(grid, df.select(*key, ts).distinct(), [*key, ts], "left_anti")
    rest = [c for c in df.columns if c not in (*key, ts)]
    return df.unionByName(gaps, allowMissingColumns=True).select(*key, ts, *rest)
