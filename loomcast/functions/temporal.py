"""Calendar parts, cyclical encodings, time texts and forecast stamps."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Periods of the cyclical encodings (365 also in leap years).
MONTHS_PER_YEAR = 12
DAYS_PER_YEAR = 365
WEEKS_PER_YEAR = 52
HOURS_PER_DAY = 24

# Months of each season, daily and hourly flavour.
DAILY_SEASONS = {
    "summer": (4, 5, 6),
    "autumn": (7, 8, 9),
    "winter": (10, 11, 12),
    "spring": (1, 2, 3),
}
HOURLY_SEASONS = {
    "hot_month": (5, 6, 7, 8),
    "cool_month": (12, 1, 2),
    "monsoon_season": (5, 6, 7, 8, 9),
    "dry_season": (11, 12, 1, 2, 3),
}
NIGHT_HOURS = (0, 1, 2, 3, 4, 5)
WEEKEND_DAYS = (5, 6)

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Year, month, day of year, ISO week, hour and weekday (Monday is 0)."""
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day_of_year": F.dayofyear(ts),
        "week_of_year": F.weekofyear(ts),
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
    }


def cyclical(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * F.lit(2 * math.pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def direction_vector(degrees: Column) -> tuple[Column, Column]:
    return F.sin(F.radians(degrees)), F.cos(F.radians(degrees))


def flag(value: Column, members: Sequence[int]) -> Column:
    return value.isin(*members).cast("int")


def is_weekend(ts: Column) -> Column:
    return flag(F.weekday(ts), WEEKEND_DAYS)


def is_night(ts: Column) -> Column:
    return flag(F.hour(ts), NIGHT_HOURS)


def season_flags(ts: Column, seasons: Mapping[str, Sequence[int]]) -> dict[str, Column]:
    return {f"is_{name}": flag(F.month(ts), months) for name, months in seasons.items()}


def parse_clock(text: Column) -> Column:
    """Time text to timestamp, null where it cannot be read; a bare clock time gets one fixed day."""
    clock = text.rlike(r"^\d{1,2}:\d{2}(:\d{2})?$")
    padded = F.when(clock, F.concat(F.lit("1970-01-01 "), text)).otherwise(text)
    return F.try_to_timestamp(padded)


def day_length_hours(sunrise: Column, sunset: Column) -> Column:
    seconds = F.timestamp_diff("SECOND", parse_clock(sunrise), parse_clock(sunset))
    return seconds / 3600.0


def forecast_time(base: Column, horizon: Column, unit: str) -> Column:
    """Base time plus ``horizon`` units (``HOUR`` or ``DAY``)."""
    return F.timestamp_add(unit, horizon.cast("int"), base)


def horizon_label(horizon: Column, unit: str = "") -> Column:
    return F.concat(F.lit("t+"), horizon.cast("string"), F.lit(unit))


def horizon_number(name: Column) -> Column:
    """Numeric horizon of a name such as ``target_temp_t+10h``, for ordering by number."""
    return F.regexp_extract(name, r"t\+(\d+)", 1).cast("int")


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def clock_text(text: Column) -> Column:
    """``HH:mm`` of a time text, the text itself where it cannot be read."""
    return F.coalesce(F.date_format(parse_clock(text), "HH:mm"), text)


def is_iso_timestamp(text: Column) -> Column:
    """Whether a text is an ISO-8601 timestamp; a trailing ``Z`` is accepted."""
    shape = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:\d{2})?)?$")
    return F.coalesce(shape & F.try_to_timestamp(text).isNotNull(), F.lit(False))


def year_range(ts: Column, year: int, month: int | None = None) -> Column:
    """Year or (year, month) filter as a range on the time column, so that it reaches the scan."""
    if month is None:
        low, high = f"{year:04d}-01-01", f"{year + 1:04d}-01-01"
    else:
        low = f"{year:04d}-{month:02d}-01"
        high = f"{year + month // 12:04d}-{month % 12 + 1:02d}-01"
    return (ts >= F.lit(low).cast("timestamp_ntz")) & (ts < F.lit(high).cast("timestamp_ntz"))


def date_range(ts: Column, first: str | None, last: str | None) -> Column:
    """Inclusive date range as bounds on the time column."""
    condition = F.lit(True)
    if first:
        condition = condition & (ts >= F.lit(first).cast("timestamp_ntz"))
    if last:
        condition = condition & (ts < F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz"))
    return condition
