"""Feature specification: which columns a forecast job derives, as data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from loomcast.functions import numeric, temporal
from loomcast.operators.chunks import DAILY, HOURLY, SeriesShape, over_chunks
from loomcast.operators.windows import STATISTICS, lag_columns, lead_columns, target_name, trailing

# Columns that leak the target or carry no information.
LEAKAGE_COLUMNS = (
    "tempmax", "tempmin", "feelslikemax", "feelslikemin", "feelslike",
    "name", "stations", "source", "season", "conditions", "description",
    "preciptype", "snow", "snowdepth", "severerisk",
)

# Lags in rows of the daily and of the hourly job.
DAILY_LAGS = {
    "temp": (1, 3, 7),
    "dew": (1, 3, 7),
    "humidity": (1, 3, 7),
    "sealevelpressure": (1, 3, 7),
    "windspeed": (1, 3, 7),
    "precip": (1, 3, 7),
    "cloudcover": (1, 3, 7),
    "winddir_sin": (1, 3, 7),
    "winddir_cos": (1, 3, 7),
}
HOURLY_LAGS = {
    "temp": (1, 3, 6, 12, 24),
    "humidity": (1, 6, 24),
    "sealevelpressure": (6, 24),
    "windspeed": (1, 3, 6, 24),
}

# Fixed values: (columns, statistic, window sizes in rows).
DAILY_ROLLS = (
    (("precip", "humidity", "windspeed", "sealevelpressure", "cloudcover"), "mean", (7, 14, 21, 28, 56, 84)),
    (("precip", "humidity", "windspeed", "sealevelpressure", "cloudcover"), "std", (7, 14, 21, 28, 56, 84)),
)
HOURLY_ROLLS = (
    (("precip", "humidity"), "mean", (6, 24)),
    (("windspeed",), "max", (3, 24)),
)


@dataclass(frozen=True)
class FeatureSpec:
    """Everything a feature job needs to know; columns that are absent are left out."""

    shape: SeriesShape
    lags: Mapping[str, Sequence[int]]
    rolls: Sequence[tuple[Sequence[str], str, Sequence[int]]]
    seasons: Mapping[str, Sequence[int]]
    horizons: Sequence[int]
    unit: str = ""
    target: str = "temp"
    leakage: Sequence[str] = LEAKAGE_COLUMNS
    keep_bases: bool = False
    hourly: bool = False
    wind_vector: bool = True
    categories: Sequence[str] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        if any(k <= 0 for ks in self.lags.values() for k in ks) or any(h <= 0 for h in self.horizons):
            raise ValueError("lags and horizons are positive row counts")
        unknown = {s for _, s, _ in self.rolls} - set(STATISTICS)
        if unknown:
            raise ValueError(f"unknown statistics: {sorted(unknown)}")

    @property
    def history_rows(self) -> int:
        """Rows a series needs before its first complete feature row."""
        lags = [k for ks in self.lags.values() for k in ks]
        rolls = [n for _, _, sizes in self.rolls for n in sizes]
        return max([0, *lags, *rolls])

    def window_columns(self, window: WindowSpec, columns: Sequence[str]) -> list[Column]:
        known = {c: ks for c, ks in self.lags.items() if c in columns}
        out = lag_columns(window, known, self.unit)
        for names, statistic, sizes in self.rolls:
            for c in names:
                if c in columns:
                    out += [
                        trailing(window, c, statistic, n).alias(f"{c}_roll_{statistic}_{n}{self.unit}") for n in sizes
                    ]
        return out

    def calendar_columns(self) -> dict[str, Column]:
        ts = F.col(self.shape.ts)
        parts = temporal.calendar_parts(ts)
        out = {"year": parts["year"]}
        if self.hourly:
            out["hour"] = parts["hour"]
            out["is_night"] = temporal.is_night(ts)
        else:
            out["is_weekend"] = temporal.is_weekend(ts)
        cycles = [
            ("month", parts["month"], temporal.MONTHS_PER_YEAR),
            ("day", parts["day_of_year"], temporal.DAYS_PER_YEAR),
            ("week", parts["week_of_year"], temporal.WEEKS_PER_YEAR),
        ]
        if self.hourly:
            cycles.append(("hour", parts["hour"], temporal.HOURS_PER_DAY))
        for name, value, period in cycles:
            out[f"{name}_sin"], out[f"{name}_cos"] = temporal.cyclical(value, period)
        out.update(temporal.season_flags(ts, self.seasons))
        return out

    def target_names(self) -> list[str]:
        return [target_name(self.target, h, self.unit) for h in self.horizons]


def daily_spec(shape: SeriesShape = DAILY, **changes: object) -> FeatureSpec:
    values = dict(
        shape=shape,
        lags=DAILY_LAGS,
        rolls=DAILY_ROLLS,
        seasons=temporal.DAILY_SEASONS,
        horizons=tuple(range(1, 6)),
        categories=("icon",),
    )
    return FeatureSpec(**{**values, **changes})


def hourly_spec(shape: SeriesShape = HOURLY, **changes: object) -> FeatureSpec:
    values = dict(
        shape=shape,
        lags=HOURLY_LAGS,
        rolls=HOURLY_ROLLS,
        seasons=temporal.HOURLY_SEASONS,
        horizons=tuple(range(1, 25)),
        unit="h",
        leakage=(*LEAKAGE_COLUMNS, "icon"),
        keep_bases=True,
        hourly=True,
        wind_vector=False,
    )
    return FeatureSpec(**{**values, **changes})


def build_features(df: DataFrame, spec: FeatureSpec, targets: bool = False) -> DataFrame:
    """Observations to features: one window pass and one projection, bases dropped last.

    With ``targets`` the same pass adds positions and lead targets, which may cross splits.
    """
    prepared = df.drop(*spec.leakage)
    if {"sunrise", "sunset"} <= set(prepared.columns):
        length = temporal.day_length_hours(F.col("sunrise"), F.col("sunset"))
        prepared = prepared.withColumn("day_length_h", length).drop("sunrise", "sunset")
    if spec.wind_vector and "winddir" in prepared.columns:
        sine, cosine = temporal.direction_vector(F.col("winddir"))
        prepared = prepared.withColumns({"winddir_sin": sine, "winddir_cos": cosine})
    columns = prepared.columns

    def build(window: WindowSpec) -> list[Column]:
        leads = lead_columns(window, spec.target, spec.horizons, spec.unit) if targets else []
        return spec.window_columns(window, columns) + leads

    ahead = max(spec.horizons) if targets else 0
    windowed = over_chunks(prepared, spec.shape, build, back=spec.history_rows, ahead=ahead, numbered=targets)
    featured = windowed.withColumns({**spec.calendar_columns(), **numeric.interactions(columns)})
    if spec.keep_bases:
        return featured
    return featured.drop(*[c for c in spec.lags if c in columns and c != spec.target])


def feature_columns(df: DataFrame, spec: FeatureSpec) -> list[str]:
    """Numeric feature names of a feature table, in column order.

    The current value of the target is a feature where the bases are kept.
    """
    outside = {*spec.shape.key, spec.shape.ts, "pos", "series_rows", "split", *spec.categories, *spec.target_names()}
    if not spec.keep_bases:
        outside.add(spec.target)
    numbers = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [name for name, kind in df.dtypes if name not in outside and kind in numbers]


def check_contract(df: DataFrame, names: Sequence[str]) -> None:
    """Stop with the list of names a frame lacks."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing features: {', '.join(missing)}")


def project_to_contract(df: DataFrame, spec: FeatureSpec, names: Sequence[str]) -> DataFrame:
    check_contract(df, names)
    return df.select(*spec.shape.key, spec.shape.ts, *names)
