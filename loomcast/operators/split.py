"""Chronological and hashed train / dev / test splits."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from loomcast.operators.chunks import LENGTH, POSITION, SeriesShape, over_chunks, with_positions
from loomcast.operators.windows import lead_columns, target_name


def split_label(train: float = 0.7, dev: float = 0.15, later: int = 0) -> Column:
    """Split of a numbered row, or of the one ``later`` rows on: sizes are truncated, the rest is test."""
    position = F.col(POSITION) + later
    first = F.floor(F.col(LENGTH) * F.lit(train))
    second = first + F.floor(F.col(LENGTH) * F.lit(dev))
    return (
        F.when(position < first, "train").when(position < second, "dev").otherwise("test")
    )


def chronological_split(df: DataFrame, shape: SeriesShape, train: float = 0.7, dev: float = 0.15) -> DataFrame:
    """Add ``pos``, ``series_rows`` and ``split`` by row position within each series."""
    placed = df if POSITION in df.columns else with_positions(df, shape)
    return placed.withColumn("split", split_label(train, dev))


def bounded_labels(df: DataFrame, column: str, horizons: Sequence[int], unit: str = "", train: float = 0.7, dev: float = 0.15) -> DataFrame:
    """Add ``split`` to numbered rows with lead targets; a label in another split becomes null.

    The split of a later row follows from its position, so no window reads it.
    """
    names = {h: target_name(column, h, unit) for h in horizons}
    label = split_label(train, dev)
    inside = {n: F.when(split_label(train, dev, h) == label, F.col(f"`{n}`")) for h, n in names.items()}
    return df.withColumns({"split": label, **inside})


def split_targets(
    df: DataFrame,
    shape: SeriesShape,
    column: str,
    horizons: Sequence[int],
    unit: str = "",
    build: Callable[[WindowSpec], Sequence[Column]] = lambda w: [],
    back: int = 0,
) -> DataFrame:
    """``pos``, ``series_rows``, ``split`` and targets that stay inside it, from one pass.

    ``build`` adds windows of up to ``back`` rows to the same pass.
    """
    led = over_chunks(
        df, shape, lambda w: [*build(w), *lead_columns(w, column, horizons, unit)], back=back, ahead=max(horizons), numbered=True
    )
    return bounded_labels(led, column, horizons, unit)


def hashed_split(df: DataFrame, key: str, train: int = 70, dev: int = 15) -> DataFrame:
    """Random split for rows without time; a digest of the key makes reruns agree."""
    bucket = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % 100
    return df.withColumn(
        "split", F.when(bucket < train, "train").when(bucket < train + dev, "dev").otherwise("test")
    )
