"""Lags, trailing statistics and lead targets by row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from loomcast.operators.chunks import SeriesShape, over_chunks

STATISTICS = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min}


def lag_columns(window: WindowSpec, lags: Mapping[str, Sequence[int]], suffix: str = "") -> list[Column]:
    return [F.lag(c, k).over(window).alias(f"{c}_lag{k}{suffix}") for c, ks in lags.items() for k in ks]


def trailing(window: WindowSpec, column: str, statistic: str, rows: int) -> Column:
    """Statistic of the ``rows`` values before the current one; null until all are present."""
    frame = window.rowsBetween(-rows, -1)
    return F.when(F.count(column).over(frame) == rows, STATISTICS[statistic](column).over(frame))


def centred_mean(window: WindowSpec, column: str, period: int) -> Column:
    """Centred moving average over one period; null where the frame is not full.

    An even period takes ``period + 1`` rows with half weight on the two outer ones.
    """
    half = period // 2
    frame = window.rowsBetween(-half, half)
    if period % 2:
        return F.when(F.count(column).over(frame) == period, F.avg(column).over(frame))
    ends = F.lag(column, half).over(window) + F.lead(column, half).over(window)
    return F.when(
        F.count(column).over(frame) == period + 1,
        (F.sum(column).over(frame) - ends / 2) / period,
    )


def target_name(column: str, horizon: int, unit: str = "") -> str:
    return f"target_{column}_t+{horizon}{unit}"


def lead_columns(window: WindowSpec, column: str, horizons: Sequence[int], unit: str = "") -> list[Column]:
    return [F.lead(column, h).over(window).alias(target_name(column, h, unit)) for h in horizons]


def later_rows(window: WindowSpec, column: str, horizons: Sequence[int], split: str = "split") -> list[Column]:
    """Value and split of the row ``h`` steps on, one window function per horizon."""
    later = F.struct(F.col(split).alias("split"), F.col(column).alias("value"))
    return [F.lead(later, h).over(window).alias(f"__later_{h}") for h in horizons]


def bounded_targets(df: DataFrame, column: str, horizons: Sequence[int], unit: str = "", split: str = "split") -> DataFrame:
    """``later_rows`` to targets: a label in another split than its row is null."""
    kept = [c for c in df.columns if not c.startswith("__later_")]
    targets = [
        F.when(F.col(f"__later_{h}.split") == F.col(split), F.col(f"__later_{h}.value")).alias(target_name(column, h, unit))
        for h in horizons
    ]
    return df.select(*kept, *targets)


def add_lags(df: DataFrame, shape: SeriesShape, lags: Mapping[str, Sequence[int]], suffix: str = "") -> DataFrame:
    known = {c: ks for c, ks in lags.items() if c in df.columns}
    reach = max((k for ks in known.values() for k in ks), default=0)
    return over_chunks(df, shape, lambda w: lag_columns(w, known, suffix), back=reach)


def add_trailing(
    df: DataFrame, shape: SeriesShape, columns: Sequence[str], statistic: str, rows: Sequence[int], suffix: str = ""
) -> DataFrame:
    def build(w: WindowSpec) -> list[Column]:
        return [
            trailing(w, c, statistic, n).alias(f"{c}_roll_{statistic}_{n}{suffix}")
            for c in columns
            if c in df.columns
            for n in rows
        ]

    return over_chunks(df, shape, build, back=max(rows))


def add_targets(
    df: DataFrame, shape: SeriesShape, column: str, horizons: Sequence[int], unit: str = "", bounded_by: str | None = None
) -> DataFrame:
    """Lead targets; ``bounded_by`` names a split column no label may cross."""
    if bounded_by:
        later = over_chunks(df, shape, lambda w: later_rows(w, column, horizons, bounded_by), ahead=max(horizons))
        return bounded_targets(later, column, horizons, unit, bounded_by)
    return over_chunks(df, shape, lambda w: lead_columns(w, column, horizons, unit), ahead=max(horizons))
