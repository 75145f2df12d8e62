"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.session import settled


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Hang the neighbours of every node (only smaller ones, or only larger ones) on its least."""
    if small:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        joined = near.join(least, "u")
        hung = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        hung = near.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return hung.where("a != b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node that is not a root.

    ``edges`` has whole numbers a and b. The number of rounds grows with the logarithm of the
    longest chain; every round is written to the shared folder. Nodes with many edges are only
    ever aggregated and joined.
    """
    current = settled(edges.where("a != b").distinct(), "edges")
    mark = None
    while True:
        done = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.max(F.col("a") < F.col("b"))
        ).first()
        if done == mark or not done[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = done
        current = settled(_stars(_stars(current, small=False), small=True), "edges")
