"""Correlation, mutual information and variance inflation over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _present(column: str) -> Column:
    """The value as a double; NaN counts as missing."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def correlation(a: str, b: str) -> Column:
    """Pearson correlation over the rows that have both values, null where one of them is constant.

    The built-in ``corr`` stops the job on a constant column.
    """
    x = F.when(_present(b).isNotNull(), _present(a))
    y = F.when(_present(a).isNotNull(), _present(b))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlation_with(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Rows ``(feature, correlation)``: every feature in one aggregate."""
    wide = df.agg(*[correlation(c, target).alias(c) for c in features])
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("correlation")) for c in features]
    return wide.select(F.inline(F.array(*pairs)))


# Spread below this share of the square sum is rounding: the column is constant.
CONSTANT = 1e-13
MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def _cross_products(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Moments of every pair of columns over the rows of a partition that have both values."""
    i, j = np.triu_indices(width, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, first, square, product = (np.zeros((width, width)) for _ in range(4))
        for batch in batches:
            has = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
            count += has.T @ has
            first += x.T @ has
            square += (x * x).T @ has
            product += x.T @ x
        sums = (count[i, j], first[i, j], first[j, i], square[i, j], square[j, i], product[i, j])
        arrays = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *map(pa.array, sums)]
        yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", *MOMENTS])

    return run


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long matrix ``(a, b, correlation)`` with both triangles and the diagonal.

    One pass for the means, one for the cross products around them: a matrix product per Arrow
    batch and one row per pair and partition, so the plan does not grow with the columns. A pair
    uses the rows that have both values; NaN counts as missing; a constant has no correlation.
    """
    columns = list(columns)
    means = df.agg(*[F.avg(_present(c)).alias(f"m{k}") for k, c in enumerate(columns)]).first()
    centred = df.select(*[(_present(c) - F.lit(means[k] or 0.0)).alias(f"x{k}") for k, c in enumerate(columns)])
    parts = centred.mapInArrow(_cross_products(len(columns)), "i int, j int, " + ", ".join(f"{m} double" for m in MOMENTS))
    total = parts.groupBy("i", "j").agg(*[F.sum(m).alias(m) for m in MOMENTS])
    spread_x, spread_y = F.expr("sxx - try_divide(sx * sx, n)"), F.expr("syy - try_divide(sy * sy, n)")
    varies = (F.col("n") > 0) & (spread_x > CONSTANT * F.col("sxx")) & (spread_y > CONSTANT * F.col("syy"))
    value = F.when(varies, F.expr("sxy - try_divide(sx * sy, n)") / F.sqrt(spread_x * spread_y))
    found = total.select("i", "j", value.alias("correlation"))
    cells = [(a, b, min(k, m), max(k, m)) for k, a in enumerate(columns) for m, b in enumerate(columns)]
    named = df.sparkSession.createDataFrame(cells, "a string, b string, i int, j int")
    return named.join(found, ["i", "j"], "left").select(
        "a", "b", F.when(F.col("i") == F.col("j"), 1.0).otherwise(F.col("correlation")).alias("correlation")
    )


def variance_inflation(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows ``(feature, vif)`` from the correlation matrix; only that p x p matrix reaches the driver.

    A constant feature has no factor, an exact combination of the others has an infinite one.
    """
    cells = {(r["a"], r["b"]): r["correlation"] for r in correlation_matrix(df, features).collect()}
    varying = [c for c in features if len(features) == 1 or any(cells[(c, o)] is not None for o in features if o != c)]
    matrix = np.array([[cells[(a, b)] for b in varying] for a in varying], dtype=float)
    factors: dict[str, float | None] = dict.fromkeys(features)
    for i, c in enumerate(varying):
        others = [j for j in range(len(varying)) if j != i]
        explained = matrix[i, others] @ np.linalg.pinv(matrix[np.ix_(others, others)]) @ matrix[others, i]
        factors[c] = float(1 / (1 - explained)) if 1 - explained > 1e-10 else float("inf")
    spark: SparkSession = df.sparkSession
    return spark.createDataFrame(list(factors.items()), "feature string, vif double")


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = 20) -> DataFrame:
    """Rows ``(feature, mutual_info)`` from joint histograms of equal-width bins.

    Rows are reduced to ``features * bins * bins`` counts before the shuffle.
    """
    ends = df.agg(*[f(c).alias(f"{c}__{n}") for c in (*features, target) for n, f in (("lo", F.min), ("hi", F.max))]).first()

    def binned(c: str):
        low, high = ends[f"{c}__lo"], ends[f"{c}__hi"]
        if low is None or high == low:
            return F.when(F.col(c).isNotNull(), F.lit(0))
        width = F.lit(float(high - low))
        return F.least(F.floor((F.col(c) - F.lit(float(low))) / width * bins), F.lit(bins - 1)).cast("int")

    pairs = [F.struct(F.lit(c).alias("feature"), binned(c).alias("bx"), binned(target).alias("by")) for c in features]
    cells = (
        df.select(F.inline(F.array(*pairs)))
        .where("bx IS NOT NULL AND by IS NOT NULL")
        .groupBy("feature", "bx", "by")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total, mx, my = (Window.partitionBy(*c) for c in (("feature",), ("feature", "bx"), ("feature", "by")))
    shares = cells.select(
        "feature",
        "n",
        F.sum("n").over(total).alias("t"),
        F.sum("n").over(mx).alias("nx"),
        F.sum("n").over(my).alias("ny"),
    )
    term = F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t") / (F.col("nx") * F.col("ny")))
    return shares.groupBy("feature").agg(F.sum(term).alias("mutual_info"))
