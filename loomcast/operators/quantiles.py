"""Exact quantiles and modes without gathering a column into one task.

``percentile`` keeps every distinct value of a group in one buffer. Here each wanted rank is
enclosed by an open bracket of two values. A bounded sketch gives the first bracket; counts tell
how many rows lie below and inside, and a bracket that holds more than ``most`` rows is narrowed
by another sketch of its own rows only. Then the rows inside are sorted, and no more than
``most`` of them meet per group, column and rank however large the table is. Values that fill
more than their share end up as an edge of a bracket, where they are only counted. Sketches
decide the cost, never the result: a rank outside its bracket stops the job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.operators.chunks import null_safe_join
from loomcast.session import settled

ACCURACY = 10_000
MOST = 200_000
# Positions at which the rows of a bracket are sketched to narrow it.
GRID = [i / 1000 for i in range(1001)]


@dataclass(frozen=True)
class Ranks:
    """Wanted places in a sorted column: ``place(n, nulls)`` from 0 to n - 1, as a double.

    A place between two rows asks for both; a null place asks for nothing. ``shares`` are the
    points at which the column is sketched, and ``width`` is the share of its rows that a bracket
    of these points holds at most. ``at`` has the share of each place where it is known
    beforehand; otherwise the points are those of ``GRID``.
    """

    places: Sequence[Callable[[Column, Column], Column]]
    shares: Sequence[float] = tuple(GRID)
    width: float = 0.004
    at: Sequence[float] | None = None


@dataclass(frozen=True)
class _Target:
    """Expressions over one column and one of its brackets."""

    column: str
    i: int

    @property
    def prefix(self) -> str:
        return f"{self.column}__{self.i}"

    def of(self, name: str) -> Column:
        return F.col(f"`{self.prefix}_{name}`")

    @property
    def value(self) -> Column:
        return F.col(f"`{self.column}`")

    @property
    def inside(self) -> Column:
        low, high = self.of("low"), self.of("high")
        return self.value.isNotNull() & (low.isNull() | (self.value > low)) & (high.isNull() | (self.value < high))

    def counts(self) -> list[Column]:
        """Rows below the bracket, up to its low edge, inside, and up to its high edge."""
        to_high = F.when(self.of("high").isNull(), self.value.isNotNull()).otherwise(self.value <= self.of("high"))
        named = {
            "under": F.count_if(self.value < self.of("low")),
            "upto": F.count_if(self.value <= self.of("low")),
            "mid": F.count_if(self.inside),
            "within": F.count_if(to_high),
        }
        return [c.alias(f"{self.prefix}_{n}") for n, c in named.items()]


def _edges(points: Column, shares: Sequence[float], at: float, slack: float) -> tuple[Column, Column]:
    """Sketched points on both sides of a known share; null, which is open, beyond the outermost."""
    low = [j for j, share in enumerate(shares) if share < at - slack]
    high = [j for j, share in enumerate(shares) if share > at + slack]
    point = lambda found: F.get(points, F.lit(found)) if found is not None else F.lit(None).cast("double")
    return point(low[-1] if low else None), point(high[0] if high else None)


def _grid_edges(points: Column, share: Column, slack: float) -> tuple[Column, Column]:
    """``_edges`` for the even grid and a share that only the rows tell, by arithmetic."""
    steps = len(GRID) - 1
    low = F.ceil((share - slack) * steps) - 1
    high = F.floor((share + slack) * steps) + 1
    return F.when(low >= 0, F.get(points, low.cast("int"))), F.when(high <= steps, F.get(points, high.cast("int")))


def _marked(data: DataFrame, brackets: DataFrame, by: list[str]) -> DataFrame:
    """Every row with the brackets of its group; those of a table without groups are literals."""
    if by:
        return null_safe_join(data, brackets, by)
    row = brackets.first()
    return data.select("*", *[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in brackets.schema.fields])


def _first_brackets(data: DataFrame, ranks: dict[str, Ranks], by: list[str], accuracy: int) -> DataFrame:
    sketches = data.groupBy(*by).agg(
        *[F.percentile_approx(f"`{c}`", list(r.shares), accuracy).alias(f"{c}__points") for c, r in ranks.items()],
        *[F.count(f"`{c}`").alias(f"{c}__n") for c in ranks],
        *[F.count_if(f"`{c}__null`").alias(f"{c}__nulls") for c in ranks],
    )
    out = []
    for c, r in ranks.items():
        n, points = F.col(f"`{c}__n`"), F.col(f"`{c}__points`")
        out += [n, F.col(f"`{c}__nulls`")]
        for i, place in enumerate(r.places):
            wanted = place(n, F.col(f"`{c}__nulls`"))
            share = wanted / F.greatest(n - 1, F.lit(1))
            # The sketch is off by 1 / accuracy at most, and a place may fall between two rows.
            slack = 2 / accuracy
            low, high = _edges(points, r.shares, r.at[i], slack) if r.at else _grid_edges(points, share, slack)
            # A group this small is cheaper taken whole than bracketed.
            large = n > 5 * accuracy
            out += [
                wanted.alias(f"{c}__{i}_place"),
                F.when(large, low).alias(f"{c}__{i}_low"),
                F.when(large, high).alias(f"{c}__{i}_high"),
            ]
    return sketches.select(*by, *out)


def _narrowed(data: DataFrame, brackets: DataFrame, targets: list[_Target], by: list[str], most: int, accuracy: int) -> tuple[DataFrame, bool]:
    """Counted brackets, those with more than ``most`` rows narrowed; whether all had fewer."""
    marked = _marked(data, brackets, by)
    counted = marked.groupBy(*by).agg(
        *[c for t in targets for c in t.counts()],
        *[F.percentile_approx(F.when(t.inside, t.value), GRID, accuracy).alias(f"{t.prefix}_points") for t in targets],
    )
    joined = settled(_marked(counted, brackets, by), "quantile-counts")
    full = reduce(F.greatest, [F.coalesce(F.max(t.of("mid")), F.lit(0)) for t in targets], F.lit(0).cast("long"))
    if joined.agg(full.alias("full")).first()["full"] <= most:
        return brackets, True
    changed = {}
    for t in targets:
        place, upto, mid = t.of("place"), t.of("upto"), t.of("mid")
        low, high = _grid_edges(t.of("points"), (place - upto) / F.greatest(mid - 1, F.lit(1)), 2 / accuracy)
        over = mid > most
        at_low, at_high = F.ceil(place) < upto, F.floor(place) >= upto + mid
        # Where both rows of a place are at an edge, nothing inside is wanted.
        changed[f"{t.prefix}_low"] = F.when(over & at_high, t.of("high")).when(over & ~at_low, F.coalesce(low, t.of("low"))).otherwise(t.of("low"))
        changed[f"{t.prefix}_high"] = F.when(over & at_low, t.of("low")).when(over & ~at_high, F.coalesce(high, t.of("high"))).otherwise(t.of("high"))
    return settled(joined.withColumns(changed).select(*brackets.columns), "quantile-brackets"), False


def _inside_rows(marked: DataFrame, targets: list[_Target], by: list[str]) -> DataFrame:
    """Distinct values inside the brackets with their copies: (by..., feature, i, v, copies)."""
    # Nearly all rows end here, before any array is built for them.
    some = marked.where(reduce(lambda a, b: a | b, [t.inside for t in targets]))
    entries = [
        F.when(t.inside, F.struct(F.lit(t.column).alias("feature"), F.lit(t.i).alias("i"), t.value.alias("v"))) for t in targets
    ]
    rows = some.select(*by, F.inline(F.array_compact(F.array(*entries))))
    return rows.groupBy(*by, "feature", "i", "v").agg(F.count(F.lit(1)).alias("copies"))


def brackets_of(data: DataFrame, ranks: dict[str, Ranks], by: Sequence[str] = (), accuracy: int = ACCURACY, most: int = MOST) -> DataFrame:
    """One row per group with the bracket of every wanted rank; no bracket holds more than ``most`` rows."""
    by = list(by)
    targets = [_Target(c, i) for c, r in ranks.items() for i in range(len(r.places))]
    # One row per group, written out so that the plan knows how small it is.
    brackets = settled(_first_brackets(data, ranks, by, accuracy), "quantile-brackets")
    # A first bracket holds all rows of a small group, else its share of the largest at most.
    counts = reduce(F.greatest, [F.coalesce(F.max(f"`{c}__n`"), F.lit(0)) for c in ranks], F.lit(0).cast("long"))
    largest = brackets.agg(counts.alias("n")).first()["n"]
    if largest <= most or (5 * accuracy <= most and largest * max(r.width for r in ranks.values()) <= most):
        return brackets
    done = False
    while not done:
        brackets, done = _narrowed(data, brackets, targets, by, most, accuracy)
    return brackets


def order_statistics(
    df: DataFrame, ranks: dict[str, Ranks], by: Sequence[str] = (), accuracy: int = ACCURACY, most: int = MOST
) -> DataFrame:
    """Rows ``(by..., feature, i, n, nulls, place, left_value, right_value)`` of all wanted places.

    ``left_value`` and ``right_value`` are the rows around place i of a column; ``n`` counts its
    values without nulls and NaN. Places outside 0 to n - 1 have null values.
    """
    by = list(by)
    known = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(c) for c in ranks]
    data = df.select(*by, *known, *[F.col(f"`{c}`").isNull().alias(f"{c}__null") for c in ranks])
    brackets = brackets_of(data, ranks, by, accuracy, most)
    targets = [_Target(c, i) for c, r in ranks.items() for i in range(len(r.places))]
    marked = _marked(data, brackets, by)
    counted = marked.groupBy(*by).agg(*[c for t in targets for c in t.counts()])
    joined = _marked(counted, brackets, by)
    names = ("place", "low", "high", "under", "upto", "mid", "within")
    long = joined.select(
        *by,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(t.column).alias("feature"),
                        F.lit(t.i).alias("i"),
                        F.col(f"`{t.column}__n`").alias("n"),
                        F.col(f"`{t.column}__nulls`").alias("nulls"),
                        *[t.of(n).alias(n) for n in names],
                    )
                    for t in targets
                ]
            )
        ),
    )
    running = Window.partitionBy(*by, "feature", "i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = _inside_rows(marked, targets, by).withColumn("reached", F.sum("copies").over(running))
    both = null_safe_join(long, ranked, [*by, "feature", "i"], "left")
    reached = F.col("upto") + F.col("reached")
    found = both.groupBy(*by, "feature", "i", "n", "nulls", *names).agg(
        F.min(F.when(reached > F.floor("place"), F.col("v"))).alias("left_inside"),
        F.min(F.when(reached > F.ceil("place"), F.col("v"))).alias("right_inside"),
    )

    def at(rank: Column, inside: str) -> Column:
        sound = (rank >= F.col("under")) & (rank < F.col("within"))
        value = F.when(rank < F.col("upto"), F.col("low")).when(rank < F.col("upto") + F.col("mid"), F.col(inside)).otherwise(F.col("high"))
        wrong = F.raise_error(F.lit("quantile rank outside its bracket"))
        return F.when(rank.isNull() | (rank < 0) | (rank >= F.col("n")), F.lit(None)).when(sound, value).otherwise(wrong)

    return found.select(
        *by, "feature", "i", "n", "nulls", "place",
        at(F.floor("place"), "left_inside").alias("left_value"),
        at(F.ceil("place"), "right_inside").alias("right_value"),
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = ACCURACY,
    most: int = MOST,
) -> DataFrame:
    """Rows ``(by..., feature, p, n, value)``, linear interpolation, nulls and NaN ignored.

    A column without any value has a row with n = 0 and a null value, grouped or not.
    """
    margin = 4 / accuracy
    shares = sorted({q for p in probabilities for q in (max(p - margin, 0.0), min(p + margin, 1.0))})
    places = [lambda n, nulls, p=p: F.when(n > 0, (n - 1) * F.lit(float(p))) for p in probabilities]
    wanted = Ranks(places, shares, 2 * margin + 2 / accuracy, list(probabilities))
    found = order_statistics(df, {c: wanted for c in columns}, by, accuracy, most)
    p = F.element_at(F.array(*[F.lit(float(p)) for p in probabilities]), F.col("i") + 1)
    between = F.col("left_value") + (F.col("right_value") - F.col("left_value")) * (F.col("place") - F.floor("place"))
    # Equal rows may be infinite.
    value = F.when(F.col("left_value") == F.col("right_value"), F.col("left_value")).otherwise(between)
    return found.select(*by, "feature", p.alias("p"), "n", value.alias("value"))


def quantiles_wide(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """One row per ``(by..., feature)`` with ``q0, q1, ...`` in the order of ``probabilities``."""
    long = exact_quantiles(df, columns, probabilities, by)
    return long.groupBy(*by, "feature").agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("p") == float(p), F.col("value"))).alias(f"q{i}") for i, p in enumerate(probabilities)],
    )


def iqr_fences(df: DataFrame, columns: Sequence[str], multiplier: float = 1.5, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(by..., feature, q1, q3, lower, upper)``."""
    quartiles = quantiles_wide(df, columns, (0.25, 0.75), by)
    spread = F.col("q1") - F.col("q0")
    return quartiles.select(
        *by,
        "feature",
        F.col("q0").alias("q1"),
        F.col("q1").alias("q3"),
        (F.col("q0") - multiplier * spread).alias("lower"),
        (F.col("q1") + multiplier * spread).alias("upper"),
    )


def most_frequent(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent value per group; the smallest wins a tie."""
    counted = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("__n"))
    return counted.groupBy(*by).agg(
        F.min_by(column, F.struct((-F.col("__n")).alias("n"), F.col(column).alias("v"))).alias(column)
    )
