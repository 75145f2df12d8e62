import math

import pytest
from pyspark.sql import functions as F

from loomcast.functions import labels, numeric, temporal, text
from loomcast.spec import LEAKAGE_COLUMNS, build_features, check_contract, daily_spec, feature_columns, hourly_spec
from loomcast.operators.chunks import DAILY, HOURLY
from frames import hours, ordered


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_compass(spark):
    got = values(spark, [(0.0,), (22.4,), (22.5,), (350.0,)], "d double", labels.compass_point(F.col("d")))
    assert [g[0] for g in got] == ["N", "N", "NE", "N"]


def test_range_labels(spark):
    got = values(spark, [(None,), (2.9,), (3.0,), (11.0,)], "v double", labels.uv_level(F.col("v")), labels.risk_level(F.col("v") * 10))
    assert got == [("Unknown", "Unknown"), ("Low", "Low Risk"), ("Moderate", "Moderate Risk"), ("Extreme", "High Risk")]
    moon = values(spark, [(0.97,), (0.27,), (0.95,)], "v double", labels.moon_phase(F.col("v")))
    assert [m[0] for m in moon] == ["New Moon", "First Quarter", "Waning Crescent"]


def test_weather_text_falls_back_to_keywords(spark):
    rows = [("rain", None), ("odd", "Some RAIN"), ("odd", "Thunder"), (None, None)]
    got = values(spark, rows, "i string, c string", labels.weather_text(F.col("i"), F.col("c")))
    assert [g[0] for g in got] == ["Rainy", "Rainy", "Thunderstorm", "Fair Weather"]


def test_non_finite_and_clip(spark):
    rows = [(float("nan"),), (float("inf"),), (None,), (5.0,), (100.0,)]
    got = values(spark, rows, "v double", numeric.finite(F.col("v")), numeric.impute_and_clip(numeric.finite(F.col("v")), F.lit(1.0), F.lit(0.0), F.lit(14.5)))
    assert got == [(None, 1.0), (None, 1.0), (None, 1.0), (5.0, 5.0), (100.0, 14.5)]


def test_standardise_without_spread(spark):
    assert values(spark, [(3.0,)], "v double", numeric.standardise(F.col("v"), F.lit(1.0), F.lit(0.0))) == [(2.0,)]


def test_interval_and_display(spark):
    lower, upper = numeric.confidence_interval(F.col("v"), F.lit(1.6))
    assert values(spark, [(25.0,)], "v double", lower, upper) == [(21.9, 28.1)]
    assert values(spark, [(2.25,), (2.35,)], "v double", numeric.display(F.col("v"))) == [(2.2,), (2.4,)]


def test_diurnal_curve(spark):
    curve = numeric.diurnal_curve(F.lit(10.0), F.lit(20.0), F.col("h"))
    got = values(spark, [(14,), (20,), (8,)], "h int", curve)
    assert [g[0] for g in got] == pytest.approx([15.0, 20.0, 10.0])
    assert values(spark, [(20,)], "h int", numeric.diurnal_curve(F.lit(9.0), F.lit(9.0), F.col("h")))[0][0] == pytest.approx(10.0)


def test_day_length_and_clock(spark):
    rows = [("06:00:00", "18:30:00"), ("2024-01-01T06:00:00", "2024-01-01T17:00:00"), ("n/a", "18:00")]
    got = values(spark, rows, "a string, b string", temporal.day_length_hours(F.col("a"), F.col("b")), temporal.clock_text(F.col("a")))
    assert got == [(12.5, "06:00"), (11.0, "06:00"), (None, "n/a")]


def test_iso_check(spark):
    rows = [("2024-01-01T00:00:00",), ("2024-01-01T00:00:00Z",), ("2024-01-01",), ("01/02/2024",), ("2024-13-01T00:00:00",), (None,)]
    got = values(spark, rows, "t string", temporal.is_iso_timestamp(F.col("t")))
    assert [g[0] for g in got] == [True, True, True, False, False, False]


def test_horizons(spark):
    got = values(spark, [("target_temp_t+10h",), ("t+9h",)], "n string", temporal.horizon_number(F.col("n")), temporal.horizon_label(F.lit(3), "h"))
    assert got == [(10, "t+3h"), (9, "t+3h")]


def test_year_ranges(spark):
    df = spark.sql("SELECT explode(sequence(timestamp_ntz'2023-11-15', timestamp_ntz'2025-02-15', interval 1 day)) AS ts")
    assert df.where(temporal.year_range(F.col("ts"), 2024)).count() == 366
    assert df.where(temporal.year_range(F.col("ts"), 2023, 12)).count() == 31


def test_forecast_defaults(spark):
    df = spark.createDataFrame([(20.0, None, 3.0)], "temp double, humidity double, precip double")
    row = labels.fill_forecast_defaults(df).first()
    assert (row["tempmax"], row["tempmin"], row["dew"], row["humidity"], row["precip"], row["icon"]) == (22, 18, 15, 70, 3, "partly-cloudy-day")


def test_replies(spark):
    rows = [('```json\n{"a": 1}\n```',), ('{"b":2}',), ("[1]",), ("no json {",), ("7",)]
    got = values(spark, rows, "r string", text.parse_reply(F.col("r")))
    assert [g[0] for g in got] == ['{"a":1}', '{"b":2}', '{"raw":"[1]"}', '{"raw":"no json {"}', '{"raw":"7"}']


def test_records(spark):
    df = spark.createDataFrame([(21.0, 5.0, None)], "temp double, humidity double, icon string")
    assert df.select(text.masked_record(df)).first()[0] == '{"humidity":5.0}'
    assert df.select(text.canonical_record(df, ("icon", "humidity", "dew"))).first()[0] == '{"icon":null,"humidity":5.0,"dew":null}'


def panel(spark, n=60):
    df = hours(spark, [float(i % 11) for i in range(n)], step=24)
    extra = {c: F.col("temp") + i for i, c in enumerate(("humidity", "windspeed", "sealevelpressure", "precip", "dew", "cloudcover", "tempmax"))}
    return df.withColumns({**extra, "winddir": F.col("temp") * 30, "sunrise": F.lit("06:00:00"), "sunset": F.lit("18:00:00"), "uvindex": F.lit(2.0), "icon": F.lit("rain")})


def test_daily_features_offer_lags_rolls_and_interactions(spark):
    spec = daily_spec(DAILY)
    out = build_features(panel(spark), spec)
    assert spec.history_rows == 84
    for c in ("temp_lag7", "winddir_sin_lag3", "precip_roll_mean_14", "cloudcover_roll_std_7", "windspeed_sq", "pressure_humidity", "daylength_uv", "is_summer", "temp", "icon"):
        assert c in out.columns
    gone = {"humidity", "windspeed", "tempmax", "sunrise", *LEAKAGE_COLUMNS}
    assert not gone & set(out.columns)
    rows = ordered(out, "daylength_uv", "precip_roll_mean_7")
    assert rows[0] == (24.0, None) and rows[7][1] == pytest.approx(sum(range(7)) / 7 + 3)


def test_hourly_features_keep_bases(spark):
    out = build_features(panel(spark), hourly_spec(HOURLY))
    assert {"humidity", "temp_lag24h", "windspeed_roll_max_24h", "is_night", "hour_sin", "is_dry_season"} <= set(out.columns)
    assert "icon" not in out.columns and "is_weekend" not in out.columns
    assert "icon" not in feature_columns(out, hourly_spec(HOURLY)) and "temp" in feature_columns(out, hourly_spec(HOURLY))


def test_contract_names_what_is_missing(spark):
    with pytest.raises(ValueError, match="nope"):
        check_contract(panel(spark), ["temp", "nope"])


def test_spec_is_validated():
    with pytest.raises(ValueError):
        daily_spec(DAILY, lags={"temp": (0,)})
    with pytest.raises(ValueError):
        daily_spec(DAILY, rolls=((("temp",), "mode", (3,)),))


def test_cyclical(spark):
    sine, cosine = temporal.cyclical(F.col("m"), 12)
    ((s, c),) = values(spark, [(3,)], "m int", sine, cosine)
    assert s == pytest.approx(1) and c == pytest.approx(math.cos(math.pi / 2))
