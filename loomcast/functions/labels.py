"""Values to labels: ranges, compass, code maps, keywords, defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds (exclusive) and labels, the last label has no bound.
UV_LEVELS = ((3, "Low"), (6, "Moderate"), (8, "High"), (11, "Very High"), (None, "Extreme"))
RISK_LEVELS = ((30, "Low Risk"), (70, "Moderate Risk"), (None, "High Risk"))
MOON_PHASES = (
    (0.05, "New Moon"),
    (0.25, "Waxing Crescent"),
    (0.30, "First Quarter"),
    (0.45, "Waxing Gibbous"),
    (0.55, "Full Moon"),
    (0.70, "Waning Gibbous"),
    (0.75, "Last Quarter"),
    (None, "Waning Crescent"),
)
NEW_MOON_ABOVE = 0.95

# Compass points clockwise from north.
COMPASS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")

# Text shown for each icon code, then for keywords of the conditions text.
ICON_TEXT = {
    "clear-day": "Clear Sky",
    "clear-night": "Clear Night",
    "rain": "Rainy",
    "snow": "Snowy",
    "wind": "Windy",
    "fog": "Foggy",
    "cloudy": "Cloudy",
    "partly-cloudy-day": "Partly Cloudy",
    "partly-cloudy-night": "Partly Cloudy",
    "thunderstorm": "Thunderstorm",
}
KEYWORD_TEXT = (("rain", "Rainy"), ("thunder", "Thunderstorm"))
DEFAULT_TEXT = "Fair Weather"

# Defaults of a forecast row.
FORECAST_DEFAULTS = {
    "conditions": "AI Forecast",
    "icon": "partly-cloudy-day",
    "humidity": 70.0,
    "precip": 0.0,
    "precipprob": 20.0,
    "windspeed": 10.0,
    "winddir": 90.0,
    "windgust": 15.0,
    "sunrise": "06:00:00",
    "sunset": "18:00:00",
    "moonphase": 0.5,
    "precipcover": 0.0,
    "uvindex": 5.0,
    "visibility": 10.0,
    "cloudcover": 50.0,
    "sealevelpressure": 1013.0,
}
# Distance from the forecast temperature when a value is absent.
FORECAST_OFFSETS = {"tempmax": 2.0, "tempmin": -2.0, "dew": -5.0}


def range_label(value: Column, levels: Sequence[tuple[float | None, str]], missing: str = "Unknown") -> Column:
    label = F.when(value.isNull() | F.isnan(value.cast("double")), missing)
    for bound, text in levels:
        label = label.otherwise(text) if bound is None else label.when(value < bound, text)
    return label


def uv_level(value: Column) -> Column:
    return range_label(value, UV_LEVELS)


def risk_level(value: Column) -> Column:
    return range_label(value, RISK_LEVELS)


def moon_phase(value: Column) -> Column:
    return F.when(value > NEW_MOON_ABOVE, "New Moon").otherwise(range_label(value, MOON_PHASES))


def compass_point(degrees: Column) -> Column:
    sector = F.floor((degrees + 22.5) / 45).cast("int") % 8
    return F.get(F.array(*[F.lit(p) for p in COMPASS]), sector)


def mapped(code: Column, mapping: Mapping[str, str], default: Column) -> Column:
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), default)


def keyword_label(text: Column, keywords: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first keyword the lower-cased text contains."""
    lowered, label = F.lower(text), None
    for word, name in keywords:
        hit = lowered.contains(word)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label.otherwise(default)


def weather_text(icon: Column, conditions: Column) -> Column:
    return mapped(icon, ICON_TEXT, keyword_label(conditions, KEYWORD_TEXT, DEFAULT_TEXT))


def fill_forecast_defaults(df: DataFrame) -> DataFrame:
    """Fill what a forecast row lacks; columns that are absent are added."""
    filled = {}
    for name, value in FORECAST_DEFAULTS.items():
        filled[name] = F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
    for name, offset in FORECAST_OFFSETS.items():
        derived = F.col("temp") + offset
        filled[name] = F.coalesce(F.col(name), derived) if name in df.columns else derived
    return df.withColumns(filled)
