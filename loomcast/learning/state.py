"""Preprocessing state: fitted on training rows only, kept as a small table.

The state is one row per feature, so its size is the number of features whatever the number
of rows. Applying it is plain arithmetic with literals; no join and no Python per row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from loomcast.functions.numeric import impute_and_clip, standardise
from loomcast.operators.quantiles import Ranks, iqr_fences, order_statistics
from loomcast.session import settled

STATE_SCHEMA = "feature string, centre double, lower double, upper double, mean double, std double"


def _filled_place(share: float, missing: bool) -> Callable[[Column, Column], Column]:
    """Place of a quantile of the filled column among the values; ``missing``: less the filled rows."""

    def place(n: Column, nulls: Column) -> Column:
        at = (n + nulls - 1) * F.lit(share) - (nulls if missing else 0)
        # Outside the values, the nearest of them.
        return F.when(n > 0, F.greatest(F.least(at, (n - 1).cast("double")), F.lit(0.0)))

    return place


# Places of the median, and of both quartiles after filling: among the values before those that
# are filled in, and after them.
_PLACES = Ranks(
    [
        lambda n, nulls: F.when(n > 0, (n - 1) * F.lit(0.5)),
        *[_filled_place(share, missing) for share in (0.25, 0.75) for missing in (False, True)],
    ]
)


def _interpolated(left: float | None, right: float | None, at: float) -> float | None:
    return left if left is None or left == right else left + (right - left) * (at - math.floor(at))


def _filled_quantile(share: float, before: Row, after: Row, centre: float) -> float:
    """Quantile of a column whose ``nulls`` became ``centre``, from its own order statistics.

    In the sorted filled column the row at rank k is the k-th value if that is under the centre,
    the value at k less the filled rows if that is over it, and else the centre.
    """
    n, nulls = before["n"], before["nulls"]
    at = (n + nulls - 1) * share

    def row(rank: int, low: float, high: float) -> float:
        if rank < n and low < centre:
            return low
        return high if rank >= nulls and high > centre else centre

    left = row(math.floor(at), before["left_value"], after["left_value"])
    right = row(math.ceil(at), before["right_value"], after["right_value"])
    return _interpolated(left, right, at)


def fit_bounds(
    train: DataFrame, columns: Sequence[str], strategy: str, multiplier: float
) -> dict[str, tuple[float | None, float | None, float | None]]:
    """Centre and fences of each column; the fences are those of the filled values.

    One search for all order statistics: filling puts equal values into a sorted column, so its
    quartiles are values at other ranks of the column as it is, or the centre.
    """
    found: dict[str, dict[int, Row]] = {c: {} for c in columns}
    for r in order_statistics(train, {c: _PLACES for c in columns}).collect():
        found[r["feature"]][r["i"]] = r
    means = train.agg(*[F.avg(F.nanvl(c, F.lit(None).cast("double"))).alias(c) for c in columns]).first() if strategy == "mean" else None
    out: dict[str, tuple[float | None, float | None, float | None]] = {}
    for c, places in found.items():
        middle = places[0]
        if not middle["n"]:
            out[c] = (None, None, None)
            continue
        median = _interpolated(middle["left_value"], middle["right_value"], middle["place"])
        centre = median if means is None else means[c]
        first = _filled_quantile(0.25, places[1], places[2], centre)
        third = _filled_quantile(0.75, places[3], places[4], centre)
        out[c] = (centre, first - multiplier * (third - first), third + multiplier * (third - first))
    return out


def fit_state(
    train: DataFrame, columns: Sequence[str], strategy: str = "median", multiplier: float = 1.5
) -> list[Row]:
    """State rows; fences come from the filled values, mean and std from the clipped ones."""
    columns = list(columns)
    # Read several times below: kept in memory, on disk where it does not fit.
    rows = train.select(*[F.col(c).cast("double").alias(c) for c in columns]).persist()
    try:
        bounds = fit_bounds(rows, columns, strategy, multiplier)
        clipped = rows.select(
            *[impute_and_clip(F.col(c), *[F.lit(b).cast("double") for b in bounds[c]]).alias(c) for c in columns]
        )
        wanted = [f(c).alias(f"{c}__{n}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]
        moments = clipped.agg(*wanted).first()
    finally:
        rows.unpersist()
    return [
        Row(feature=c, centre=bounds[c][0], lower=bounds[c][1], upper=bounds[c][2], mean=moments[f"{c}__m"], std=moments[f"{c}__s"])
        for c in columns
    ]


def state_table(spark: SparkSession, state: Sequence[Row]) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in state], STATE_SCHEMA)


def load_state(table: DataFrame) -> list[Row]:
    """State rows of a stored table (one per feature)."""
    return table.select("feature", "centre", "lower", "upper", "mean", "std").collect()


def scaled(state: Row) -> Column:
    clipped = impute_and_clip(F.col(state.feature), F.lit(state.centre), F.lit(state.lower), F.lit(state.upper))
    return standardise(clipped, F.lit(state.mean), F.lit(state.std))


def apply_state(df: DataFrame, state: Sequence[Row]) -> DataFrame:
    """Fill, clip and standardise the columns of the state in one projection."""
    return df.withColumns({r.feature: scaled(r) for r in state})


def train_categories(train: DataFrame, column: str, most: int | None = None) -> list[str]:
    """Sorted categories seen in training, null as ``none``; more than an asked ``most`` is an error."""
    seen = train.select(F.coalesce(F.col(column).cast("string"), F.lit("none")).alias("c")).distinct().collect()
    if most is not None and len(seen) > most:
        raise ValueError(f"{column} has more than {most} categories; one-hot columns are not made from it")
    return sorted(r["c"] for r in seen)


def one_hot(df: DataFrame, column: str, categories: Sequence[str]) -> DataFrame:
    """Replace the column by ``<column>_<category>`` flags; unknown values are all zero."""
    value = F.coalesce(F.col(column).cast("string"), F.lit("none"))
    return df.withColumns({f"{column}_{c}": (value == c).cast("double") for c in categories}).drop(column)


def category_codes(train: DataFrame, category: Column) -> DataFrame:
    """Rows ``(category, code)``: the categories seen in training, numbered from 0 in their order.

    The table is sorted by ranges and numbered through the sizes of its parts, so no category
    reaches the driver and no task holds them all.
    """
    seen = train.select(category.cast("string").alias("category")).where("category IS NOT NULL").distinct()
    ranged = seen.repartitionByRange("category").withColumn("__part", F.spark_partition_id())
    # Written, so that the parts stay what they are while they are counted and numbered.
    parted = settled(ranged, "categories")
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parted.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy("category"))
    numbered = parted.withColumn("__rank", inside).join(starts, "__part")
    return numbered.select("category", (F.col("__start") + F.col("__rank") - 1).cast("int").alias("code"))


def ordinal(df: DataFrame, column: str, train: DataFrame) -> DataFrame:
    """Add ``<column>_code``: place among the sorted training categories, -1 when unknown.

    Codes are a table, one row per category, and are joined: any number of categories will do.
    """
    codes = category_codes(train, F.col(column)).select(F.col("category").alias("__category"), F.col("code").alias("__code"))
    joined = df.join(codes, F.col(column).cast("string") == F.col("__category"), "left")
    return joined.withColumn(f"{column}_code", F.coalesce("__code", F.lit(-1)).cast("int")).drop("__category", "__code")


def category_vector(df: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """Replace the column by ``<column>_categories``, one sparse vector of flags.

    ``codes`` are those of ``category_codes`` with null as ``none``; they are joined, so thousands
    of categories make one column. An unknown value has no flag.
    """
    sized = codes.select(F.col("category").alias("__category"), F.col("code").cast("double").alias("__code"))
    encoder = OneHotEncoder(inputCols=["__code"], outputCols=[f"{column}_categories"], dropLast=True, handleInvalid="keep").fit(sized)
    # Codes beyond the known ones are one more category, the last, which is dropped.
    unknown = encoder.categorySizes[0]
    joined = df.withColumn("__value", F.coalesce(F.col(column).cast("string"), F.lit("none")))
    coded = joined.join(sized, F.col("__value") == F.col("__category"), "left").withColumn("__code", F.coalesce("__code", F.lit(float(unknown))))
    return encoder.transform(coded).drop(column, "__value", "__category", "__code")


def _or(fence: float | None, open_end: float) -> float:
    """A column without values in training is not clipped."""
    return open_end if fence is None else float(fence)


class _ClipParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to clip", TypeConverters.toListString)
    multiplier = Param(Params._dummy(), "multiplier", "fence distance in interquartile ranges", TypeConverters.toFloat)
    lower = Param(Params._dummy(), "lower", "lower fences", TypeConverters.toListFloat)
    upper = Param(Params._dummy(), "upper", "upper fences", TypeConverters.toListFloat)


class IqrClipper(Estimator, _ClipParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns fences on the rows it is fitted on; the model clips any frame to them."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, multiplier: float = 1.5) -> None:
        super().__init__()
        self._setDefault(multiplier=1.5)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> IqrClipperModel:
        columns = self.getOrDefault("inputCols")
        rows = {r["feature"]: r for r in iqr_fences(dataset, columns, self.getOrDefault("multiplier")).collect()}
        model = IqrClipperModel()
        model._set(
            inputCols=columns,
            lower=[_or(rows[c]["lower"], float("-inf")) for c in columns],
            upper=[_or(rows[c]["upper"], float("inf")) for c in columns],
        )
        return model


class IqrClipperModel(Model, _ClipParams, DefaultParamsReadable, DefaultParamsWritable):
    """Clips to learnt fences; missing values stay missing."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fences = zip(self.getOrDefault("inputCols"), self.getOrDefault("lower"), self.getOrDefault("upper"))
        return dataset.withColumns(
            {c: F.when(F.col(c).isNotNull(), F.greatest(F.least(F.col(c), F.lit(hi)), F.lit(lo))) for c, lo, hi in fences}
        )
