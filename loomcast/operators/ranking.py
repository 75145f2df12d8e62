"""Average ranks, mean rank, top lists and comparisons of lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: rank of a feature a score does not know.
MISSING_RANK = 1e6


def align_scores(scores: Sequence[DataFrame], key: str = "feature") -> DataFrame:
    """Full outer alignment of score tables (one row per feature each)."""
    return reduce(lambda a, b: a.join(b, key, "full_outer"), scores)


def average_rank(column: str, by: Sequence[str] = ()) -> Column:
    """Descending rank; equal values share the mean of their ranks, missing ones rank last."""
    ordered = Window.partitionBy(*by).orderBy(F.col(column).desc_nulls_last())
    same = Window.partitionBy(*by, column)
    rank = F.rank().over(ordered) + (F.count(F.lit(1)).over(same) - 1) / 2
    return F.when(F.col(column).isNotNull(), rank).otherwise(F.lit(MISSING_RANK))


def add_mean_rank(scores: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add ``<column>_rank`` and ``mean_rank``; the table holds one row per feature (and ``by``)."""
    ranked = scores.withColumns({f"{c}_rank": average_rank(c, by) for c in columns})
    return ranked.withColumn("mean_rank", reduce(lambda a, b: a + b, [F.col(f"{c}_rank") for c in columns]) / len(columns))


def top_features(ranked: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """The ``n`` features of lowest mean rank, ties by name, with their place."""
    order = Window.partitionBy(*by).orderBy("mean_rank", "feature")
    return ranked.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def assign_lists(short: DataFrame, long: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """Features per horizon: first short list, last long list, between the union."""
    both = short.select("feature").union(long.select("feature")).distinct()
    parts = [
        short.select("feature", F.lit(horizons[0]).alias("horizon"), F.lit("SHORT-TERM").alias("feature_type")),
        long.select("feature", F.lit(horizons[-1]).alias("horizon"), F.lit("LONG-TERM").alias("feature_type")),
    ]
    middle = F.explode(F.array(*[F.lit(h) for h in horizons[1:-1]])).alias("horizon")
    parts.append(both.select("feature", middle, F.lit("COMBINED").alias("feature_type")))
    return reduce(DataFrame.unionByName, parts)


def overlap(short: DataFrame, long: DataFrame) -> DataFrame:
    """Rows ``(part, features)``: sizes of the union, the shared part and both remainders."""
    a, b = short.select("feature").distinct(), long.select("feature").distinct()
    parts = {"combined": a.union(b).distinct(), "shared": a.intersect(b), "short_only": a.subtract(b), "long_only": b.subtract(a)}
    counted = [d.agg(F.count(F.lit(1)).alias("features")).select(F.lit(n).alias("part"), "features") for n, d in parts.items()]
    return reduce(DataFrame.unionByName, counted)


def same_features(a: DataFrame, b: DataFrame) -> bool:
    """Whether two lists hold the same features."""
    x, y = a.select("feature").distinct(), b.select("feature").distinct()
    return x.exceptAll(y).unionAll(y.exceptAll(x)).isEmpty()
