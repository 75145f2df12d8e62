"""Forecast errors per horizon, averages, winners and shares."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def forecast_metrics(pairs: DataFrame, by: Sequence[str] = ("horizon",), y: str = "y", yhat: str = "yhat") -> DataFrame:
    """MAE, RMSE, MAPE (percent) and R2 per group in one aggregate; a zero actual has no MAPE term."""
    scored = pairs.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    error = F.col(y) - F.col(yhat)
    squares = F.sum(error * error)
    spread = F.count(F.lit(1)) * F.var_pop(y)
    return scored.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (100 * F.avg(F.abs(F.try_divide(error, F.col(y))))).alias("mape"),
        (1 - F.try_divide(squares, spread)).alias("r2"),
        F.count(F.lit(1)).alias("n_samples"),
    )


@dataclass(frozen=True)
class Pairing:
    """Columns of an actual and a forecast in a wide row, on the rows of some splits."""

    labels: Mapping[str, int | str]
    y: str
    yhat: str
    splits: tuple[str, ...]


SUMS = ("n", "absolute", "square", "relative", "nonzero", "total", "total_square")


def _sums_of_pairs(pairings: Sequence[Pairing]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of errors per pairing over the rows of a partition; a row is read once for all pairings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(pairings), len(SUMS)))
        for batch in batches:
            values = {c: batch.column(c).fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.schema.names if c != "split"}
            known = {c: batch.column(c).is_valid().to_numpy(zero_copy_only=False) for c in values}
            split = batch.column("split").to_numpy(zero_copy_only=False)
            inside = {parts: np.isin(split, parts) for parts in {p.splits for p in pairings}}
            for i, p in enumerate(pairings):
                use = inside[p.splits] & known[p.y] & known[p.yhat]
                y = values[p.y][use]
                error = np.abs(y - values[p.yhat][use])
                some = y != 0
                relative = (error[some] / np.abs(y[some])).sum()
                held[i] += (len(y), error.sum(), (error * error).sum(), relative, some.sum(), y.sum(), (y * y).sum())
        arrays = [pa.array(np.arange(len(pairings), dtype=np.int32)), *map(pa.array, np.ascontiguousarray(held.T))]
        yield pa.RecordBatch.from_arrays(arrays, names=["i", *SUMS])

    return run


def paired_metrics(df: DataFrame, pairings: Sequence[Pairing]) -> DataFrame:
    """``forecast_metrics`` of every pairing from one pass: labels, then the measures.

    ``df`` has ``split`` and the columns of the pairings. A task gives one row of sums per
    pairing, so no row is repeated per horizon and candidate. A pairing without rows has none.
    """
    columns = list(dict.fromkeys(c for p in pairings for c in (p.y, p.yhat)))
    rows = df.select("split", *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    # Columns such as those of t+1 have no dots or quotes, as Python tasks need it.
    sums = rows.mapInArrow(_sums_of_pairs(pairings), "i int, " + ", ".join(f"{c} double" for c in SUMS))
    total = sums.groupBy("i").agg(*[F.sum(c).alias(c) for c in SUMS]).where("n > 0")
    spread = F.col("total_square") - F.col("total") * F.col("total") / F.col("n")
    named = df.sparkSession.createDataFrame([(i, *p.labels.values()) for i, p in enumerate(pairings)], ["i", *pairings[0].labels])
    whole = [F.col(k).cast("int").alias(k) if isinstance(v, int) else F.col(k) for k, v in pairings[0].labels.items()]
    return named.join(total, "i").select(
        *whole,
        (F.col("absolute") / F.col("n")).alias("mae"),
        F.sqrt(F.col("square") / F.col("n")).alias("rmse"),
        (100 * F.try_divide("relative", "nonzero")).alias("mape"),
        (1 - F.try_divide(F.col("square"), spread)).alias("r2"),
        F.col("n").cast("long").alias("n_samples"),
    )


def average_metrics(metrics: DataFrame) -> DataFrame:
    """Plain mean over horizons; the mean R2 to 3 digits serves as average confidence."""
    return metrics.agg(
        *[F.avg(c).alias(c) for c in ("mae", "rmse", "mape", "r2")],
        F.bround(F.avg("r2"), 3).alias("average_confidence"),
    )


def winners(trials: DataFrame) -> DataFrame:
    """Trial of lowest error per horizon; model and parameters decide a tie."""
    best = F.min_by(F.struct("model", "params", "rmse", "mae"), F.struct("rmse", "model", "params"))
    return trials.groupBy("horizon").agg(best.alias("b")).select("horizon", "b.*")


def model_shares(best: DataFrame) -> DataFrame:
    counted = best.groupBy("model").agg(F.count(F.lit(1)).alias("horizons"))
    share = F.col("horizons") * 100.0 / F.sum("horizons").over(Window.partitionBy())
    return counted.withColumn("percent", share)
