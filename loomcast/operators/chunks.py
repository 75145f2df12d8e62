"""Row positions and row windows that never put a whole series into one task.

A window partitioned by the series key alone sends every row of a series to one task, and a
window without a key sends the whole table to one. Here the rows of a series are cut into time
buckets of about ``chunk_rows`` rows, and all steps read the same shuffle by (series, bucket):

1. Buckets are counted, and the counts, one row per bucket, are summed up per series to the
   position that each bucket starts at.
2. Rows that are far enough from both ends of their bucket find all rows that their windows
   reach inside it; their windows are final.
3. Rows near an end, a few per bucket, get their positions from the starts. They are cut into
   chunks by position, with the rows before and after copied from the neighbours, and windowed.

All is exact for rows at irregular times: distances are counted in rows, however many buckets
they cross. Rows are shuffled once and not stored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

POSITION = "pos"
LENGTH = "series_rows"


@dataclass(frozen=True)
class SeriesShape:
    """How the rows of a frame form series: key columns, time column, cadence in seconds."""

    key: tuple[str, ...] = ("series_id",)
    ts: str = "ts"
    step: int = 3600
    chunk_rows: int = 4096

    def with_chunk(self, rows: int) -> SeriesShape:
        return replace(self, chunk_rows=rows)


HOURLY = SeriesShape(step=3600)
DAILY = SeriesShape(step=86400)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp, independent of the session zone."""
    return (
        F.unix_date(ts.cast("date")).cast("long") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def null_safe_join(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal columns where a missing key equals a missing key; right keys are dropped."""
    renamed = right.select(*[F.col(c).alias(f"__right_{c}") if c in columns else F.col(c) for c in right.columns])
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__right_{c}"))
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__right_{c}" for c in columns])


def _bucketed(df: DataFrame, shape: SeriesShape, least: int = 1) -> tuple[DataFrame, list[str]]:
    """Rows shuffled by series and time bucket, and the columns that name a bucket.

    The columns are never null, so that joins on them keep the partitioning: a missing key is a
    series, and rows without time form the first bucket of theirs.
    """
    names: dict[str, Column] = {}
    for i, k in enumerate(shape.key):
        names[f"__key{i}"] = F.coalesce(F.col(k).cast("string"), F.lit(""))
        names[f"__null{i}"] = F.col(k).isNull()
    span = shape.step * max(shape.chunk_rows, least)
    names["__bucket"] = F.coalesce(F.floor(epoch_seconds(F.col(shape.ts)) / span), F.lit(-(1 << 62)))
    return df.withColumns(names).repartition(*names), list(names)


def _starts(rows: DataFrame, names: list[str]) -> DataFrame:
    """Position of the first row of every bucket, and the rows of its series."""
    # The count is what counts(1) gives. It mentions all columns because a shuffle of fewer columns
    # would be another shuffle, for which the input is evaluated again.
    rows_in = F.count(F.lit(1))
    others = [f for f in rows.schema.fields if f.name not in names]
    seen = [F.count(f.name) if f.nullable else F.least(rows_in, F.max(F.hash(f.name)).cast("long")) for f in others]
    sizes = rows.groupBy(*names).agg((F.greatest(rows_in, *seen) if seen else rows_in).alias("__size"))
    # One row per bucket: a series of a billion rows is about 250,000 rows here.
    series = Window.partitionBy(*names[:-1])
    so_far = series.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        *names,
        F.coalesce(F.sum("__size").over(so_far), F.lit(0)).alias("__start"),
        F.sum("__size").over(series).alias(LENGTH),
    )


def _ranked(rows: DataFrame, shape: SeriesShape, names: list[str]) -> tuple[DataFrame, WindowSpec]:
    inside = Window.partitionBy(*names)
    ordered = inside.orderBy(shape.ts)
    added = {"__rank": F.row_number().over(ordered).cast("long"), "__size": F.count(F.lit(1)).over(inside)}
    return rows.withColumns(added), ordered


def _numbered(ranked: DataFrame, starts: DataFrame, names: list[str]) -> DataFrame:
    return ranked.join(starts, names).withColumn(POSITION, F.col("__start") + F.col("__rank") - 1)


def with_positions(df: DataFrame, shape: SeriesShape) -> DataFrame:
    """Add ``pos`` (0-based row number in time order) and ``series_rows`` per series.

    ``(key, ts)`` must be unique; deduplicate first where it is not. Rows are shuffled once, by
    series and bucket; hand over the needed columns only.
    """
    rows, names = _bucketed(df, shape)
    ranked, _ = _ranked(rows, shape, names)
    return _numbered(ranked, _starts(rows, names), names).select(*df.columns, POSITION, LENGTH)


def over_chunks(
    df: DataFrame,
    shape: SeriesShape,
    build: Callable[[WindowSpec], Sequence[Column]],
    back: int = 0,
    ahead: int = 0,
    numbered: bool = False,
) -> DataFrame:
    """Append the window columns ``build(window)``; they may reach ``back`` / ``ahead`` rows.

    With ``numbered`` the rows have ``pos`` and ``series_rows`` too. ``(key, ts)`` must be unique.
    """
    if POSITION in df.columns:
        return _over_positions(df, shape, build, back, ahead)
    reach = back + ahead
    rows, names = _bucketed(df, shape, reach)
    ranked, ordered = _ranked(rows, shape, names)
    kept = [*df.columns, POSITION, LENGTH] if numbered else df.columns
    windowed = ranked.select("*", *build(ordered))
    made = [c for c in windowed.columns if c not in ranked.columns]
    if not reach and not numbered:
        return windowed.select(*kept, *[_named(c) for c in made])
    starts = _starts(rows, names)
    inner = (F.col("__rank") > back) & (F.col("__size") - F.col("__rank") >= ahead)
    inside = windowed.where(inner)
    if numbered:
        inside = _numbered(inside, starts, names)
    # All that rows near an end reach lies this near to an end itself, or in a bucket of fewer rows.
    edges = ranked.where((F.col("__rank") <= reach) | (F.col("__size") - F.col("__rank") < reach))
    placed = _numbered(edges, starts, names).withColumn("__inner", inner)
    outside = _over_positions(placed, shape, build, back, ahead).where("NOT __inner")
    columns = [*kept, *[_named(c) for c in made]]
    return inside.select(*columns).unionByName(outside.select(*columns))


def _named(column: str) -> str:
    return f"`{column}`"


def _over_positions(
    placed: DataFrame, shape: SeriesShape, build: Callable[[WindowSpec], Sequence[Column]], back: int, ahead: int
) -> DataFrame:
    """Windows over numbered rows: one shuffle by series and chunk of positions.

    The last ``back`` rows of a chunk are copied into the next one and the first ``ahead`` rows
    into the one before; copies are dropped after the windows.
    """
    size = max(shape.chunk_rows, back, ahead)
    home = F.floor(F.col(POSITION) / size)
    offset = F.col(POSITION) % size
    homes = [home]
    if back:
        homes.append(F.when((offset >= size - back) & ((home + 1) * size < F.col(LENGTH)), home + 1))
    if ahead:
        homes.append(F.when((offset < ahead) & (home > 0), home - 1))
    spread = placed.select("*", home.alias("__home"), F.explode(F.array_compact(F.array(*homes))).alias("__chunk"))
    window = Window.partitionBy(*shape.key, "__chunk").orderBy(POSITION)
    return spread.select("*", *build(window)).where("__chunk = __home").drop("__home", "__chunk")
