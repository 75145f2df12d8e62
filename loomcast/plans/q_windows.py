"""Queries over row windows, splits, ranks, duplicates and decomposition."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.functions.temporal import DAILY_SEASONS, direction_vector
from loomcast.learning.state import one_hot, train_categories
from loomcast.operators import dedup, split
from loomcast.operators.chunks import DAILY, HOURLY, over_chunks
from loomcast.operators.decompose import decompose
from loomcast.operators.grid import densify
from loomcast.operators.ranking import add_mean_rank
from loomcast.operators.windows import add_lags, add_trailing
from loomcast.plans.catalog import query, r, rnd, rounded, rr
from loomcast.plans.panels import (
    DAILY_HORIZONS, DAILY_SQL, HOURLY_HORIZONS, HOURLY_SQL, SINGLE, SINGLE_SQL,
    daily_panel, daily_splits, hourly_panel, placed_sql, single_series,
)
from loomcast.plans.q_rows import FORECAST_SQL, history_and_forecast
from loomcast.plans.q_scores import RANK_SCORES, RANKING_SQL, feature_scores, panel_ranking
from loomcast.session import settled
from loomcast.sources.readers import table
from loomcast.spec import DAILY_LAGS, DAILY_ROLLS, HOURLY_LAGS, build_features, daily_spec, feature_columns, hourly_spec

SERIES = "PARTITION BY series_id ORDER BY ts"


def frame(rows: int, partition: str = SERIES) -> str:
    return f"({partition} ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING)"


def trailing_sql(column: str, function: str, rows: int, name: str, digits: int = 6, partition: str = SERIES) -> str:
    over = frame(rows, partition)
    return f"{r(f'CASE WHEN count({column}) OVER {over} = {rows} THEN {function}({column}) OVER {over} END', digits)} AS {name}"


def lag_sql(lags, suffix="", skip=()) -> str:
    return ", ".join(
        f"{r(f'lag({c}, {k}) OVER ({SERIES})', 4)} AS {c}_lag{k}{suffix}" for c, ks in lags.items() if c not in skip for k in ks
    )


@query("wn01_lag", f"WITH {HOURLY_SQL} SELECT series_id, ts, {lag_sql(HOURLY_LAGS, 'h')} FROM h")
def lags(spark, folder):
    out = add_lags(hourly_panel(spark, folder).select("series_id", "ts", *HOURLY_LAGS), HOURLY, HOURLY_LAGS, "h")
    return out.select("series_id", "ts", *[rnd(c, 4).alias(c) for c in out.columns if "_lag" in c])


WIND_SQL = "w AS (SELECT *, sin(radians(winddir)) AS winddir_sin, cos(radians(winddir)) AS winddir_cos FROM d)"


@query("wn01_lag_daily", f"WITH {DAILY_SQL}, {WIND_SQL} SELECT series_id, ts, {lag_sql(DAILY_LAGS)} FROM w")
def daily_lags(spark, folder):
    """Nine columns, three lags each, wind as a vector."""
    sine, cosine = direction_vector(F.col("winddir"))
    panel = daily_panel(spark, folder).withColumns({"winddir_sin": sine, "winddir_cos": cosine})
    out = add_lags(panel.select("series_id", "ts", *DAILY_LAGS), DAILY, DAILY_LAGS)
    return out.select("series_id", "ts", *[rnd(f"{c}_lag{k}", 4).alias(f"{c}_lag{k}") for c, ks in DAILY_LAGS.items() for k in ks])


@query(
    "wn01_lag_single_series",
    f"WITH {SINGLE_SQL} SELECT ts, {r('lag(temp, 1) OVER (ORDER BY ts)', 4)} AS temp_lag1, {r('lag(temp, 7) OVER (ORDER BY ts)', 4)} AS temp_lag7 FROM o",
)
def single_series_lags(spark, folder):
    """One series without a key, cut into chunks of 512 rows."""
    out = add_lags(single_series(spark, folder), SINGLE.with_chunk(512), {"temp": (1, 7)})
    return out.select("ts", rounded("temp_lag1", 4), rounded("temp_lag7", 4))


@query(
    "wn02_lag_one_hot",
    f"""WITH {DAILY_SQL}, {placed_sql('d')}, e AS (SELECT series_id, ts, (coalesce(icon, 'none') = 'clear-day')::DOUBLE AS a,
  (coalesce(icon, 'none') = 'none')::DOUBLE AS b FROM splits)
SELECT series_id, ts, lag(a, 1) OVER w AS "icon_clear-day_lag1", lag(a, 3) OVER w AS "icon_clear-day_lag3",
  lag(b, 1) OVER w AS icon_none_lag1, lag(b, 3) OVER w AS icon_none_lag3 FROM e WINDOW w AS ({SERIES})""",
)
def one_hot_lags(spark, folder):
    rows = settled(daily_splits(spark, folder, "icon"), "icons")
    categories = train_categories(rows.where("split = 'train'"), "icon")
    encoded = one_hot(rows, "icon", categories)
    names = [f"icon_{c}" for c in categories]
    lagged = add_lags(encoded, DAILY, {c: (1, 3) for c in names}).drop(*names)
    wanted = [f"icon_{c}_lag{k}" for c in ("clear-day", "none") for k in (1, 3)]
    return lagged.select("series_id", "ts", *[F.col(f"`{c}`") for c in wanted])


ROLLED = (7, 14, 21, 28, 56, 84)


@query(
    "wn03_trailing_mean",
    f"WITH {DAILY_SQL} SELECT series_id, ts, {', '.join(trailing_sql(c, 'avg', n, f'{c}_roll_mean_{n}') for c in ('precip', 'humidity') for n in ROLLED)} FROM d",
)
def trailing_mean(spark, folder):
    out = add_trailing(daily_panel(spark, folder).select("series_id", "ts", "precip", "humidity"), DAILY, ("precip", "humidity"), "mean", ROLLED)
    return out.select("series_id", "ts", *[rounded(c) for c in out.columns if "_roll_" in c])


@query(
    "wn04_trailing_std",
    f"WITH {DAILY_SQL} SELECT series_id, ts, {', '.join(trailing_sql(c, 'stddev_samp', n, f'{c}_roll_std_{n}') for c in ('precip', 'humidity') for n in ROLLED)} FROM d",
)
def trailing_std(spark, folder):
    out = add_trailing(daily_panel(spark, folder).select("series_id", "ts", "precip", "humidity"), DAILY, ("precip", "humidity"), "std", ROLLED)
    return out.select("series_id", "ts", *[rounded(c) for c in out.columns if "_roll_" in c])


@query(
    "wn05_trailing_max",
    f"WITH {HOURLY_SQL} SELECT series_id, ts, {trailing_sql('windspeed', 'max', 3, 'windspeed_roll_max_3h')}, {trailing_sql('windspeed', 'max', 24, 'windspeed_roll_max_24h')} FROM h",
)
def trailing_max(spark, folder):
    out = add_trailing(hourly_panel(spark, folder).select("series_id", "ts", "windspeed"), HOURLY, ("windspeed",), "max", (3, 24), "h")
    return out.select("series_id", "ts", rounded("windspeed_roll_max_3h"), rounded("windspeed_roll_max_24h"))


@query(
    "wn06_lead_targets",
    f"WITH {HOURLY_SQL} SELECT series_id, ts, lead(ts, 24) OVER ({SERIES}) AS label_ts, "
    + ", ".join(f"{r(f'lead(temp, {h}) OVER ({SERIES})')} AS target_{h}" for h in HOURLY_HORIZONS)
    + " FROM h",
)
def lead_targets(spark, folder):
    def build(w):
        leads = [rnd(F.lead("temp", h).over(w), 6).alias(f"target_{h}") for h in HOURLY_HORIZONS]
        return [F.lead("ts", 24).over(w).alias("label_ts"), *leads]

    out = over_chunks(hourly_panel(spark, folder).select("series_id", "ts", "temp"), HOURLY, build, ahead=24)
    return out.select("series_id", "ts", "label_ts", *[f"target_{h}" for h in HOURLY_HORIZONS])


@query(
    "wn07_split_bounded_targets",
    f"WITH {DAILY_SQL}, {placed_sql('d')} SELECT series_id, ts, split, "
    + ", ".join(f"{r(f'lead(temp, {h}) OVER (PARTITION BY series_id, split ORDER BY ts)')} AS target_{h}" for h in DAILY_HORIZONS)
    + " FROM splits",
)
def bounded_targets(spark, folder):
    out = split.split_targets(daily_panel(spark, folder).select("series_id", "ts", "temp"), DAILY, "temp", DAILY_HORIZONS)
    return out.select("series_id", "ts", "split", *[rnd(f"`target_temp_t+{h}`", 6).alias(f"target_{h}") for h in DAILY_HORIZONS])


@query("wn08_chronological_split", f"WITH {HOURLY_SQL}, {placed_sql('h')} SELECT series_id, ts, pos, series_rows, split FROM splits")
def chronological_split(spark, folder):
    out = split.chronological_split(hourly_panel(spark, folder).select("series_id", "ts"), HOURLY)
    return out.select("series_id", "ts", "pos", "series_rows", "split")


@query("wn09_average_rank", f"{RANKING_SQL} SELECT feature, correlation_rank, mutual_info_rank, long_correlation_rank FROM ranks")
def average_rank(spark, folder):
    """Ranks of three score vectors; a feature without a score ranks at a million."""
    ranked = add_mean_rank(feature_scores(spark, folder), RANK_SCORES)
    return ranked.select("feature", *[f"{c}_rank" for c in RANK_SCORES])


@query("wn10_mean_rank", f"{RANKING_SQL} SELECT feature, place, {r('mean_rank')} AS mean_rank FROM placed_rank")
def mean_rank(spark, folder):
    return panel_ranking(spark, folder).select("feature", "place", rounded("mean_rank"))


@query(
    "wn11_keep_first",
    """SELECT event_type, date_trunc('hour', ts) AS ts, min_by(event_id, (ts, event_id)) AS event_id, min_by(value, (ts, event_id)) AS value
FROM events GROUP BY 1, 2""",
)
def keep_first(spark, folder):
    """Many events share type and hour; the earliest one stays."""
    events = table(spark, folder, "events").select(
        "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "ts", "event_id", "value"
    )
    out = dedup.keep_first(events, ["event_type", "hour"], ["ts", "event_id"])
    return out.select("event_type", F.col("hour").alias("ts"), "event_id", "value")


@query("wn12_forecast_wins", f"WITH {FORECAST_SQL} SELECT series_id, ts, {r('temp')} AS temp, precip, is_forecast FROM merged")
def forecast_wins(spark, folder):
    merged = dedup.merge_history_and_forecast(*history_and_forecast(spark, folder), ["series_id", "ts"])
    return merged.select("series_id", "ts", rounded("temp"), "precip", "is_forecast")


def decompose_sql(table_name: str, key: str, digits: int) -> str:
    part = f"PARTITION BY {key} " if key else ""
    lead = f"{key}, " if key else ""
    join = f"USING ({lead}phase)"
    return f"""n AS (SELECT {lead}ts, temp, (row_number() OVER ({part}ORDER BY ts) - 1) % 7 AS phase,
  CASE WHEN count(temp) OVER ({part}ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) = 7
    THEN avg(temp) OVER ({part}ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) END AS trend FROM {table_name}),
m AS (SELECT {lead}phase, avg(temp - trend) AS s FROM n GROUP BY ALL),
c AS (SELECT {lead}phase, s - avg(s) OVER ({part.strip()}) AS seasonal FROM m)
SELECT {lead}ts, {r('temp', digits)} AS temp, {r('trend', digits)} AS trend, {r('seasonal', digits)} AS seasonal,
  {r('temp - trend - seasonal', digits)} AS resid FROM n JOIN c {join}"""


@query("wn13_decomposition", f"WITH {DAILY_SQL}, {decompose_sql('d', 'series_id', 6)}")
def decomposition(spark, folder):
    out = decompose(daily_panel(spark, folder).select("series_id", "ts", "temp"), DAILY)
    return out.select("series_id", "ts", *[rounded(c) for c in ("temp", "trend", "seasonal", "resid")])


@query("wn13_decomposition_single_series", f"WITH {SINGLE_SQL}, {decompose_sql('o', '', 4)}")
def single_decomposition(spark, folder):
    out = decompose(single_series(spark, folder).select("ts", "temp"), SINGLE.with_chunk(512))
    return out.select("ts", *[rounded(c, 4) for c in ("temp", "trend", "seasonal", "resid")])


@query(
    "wn14_calendar_grid",
    f"""WITH {HOURLY_SQL}, e AS (SELECT series_id, min(ts) AS a, max(ts) AS z FROM h GROUP BY 1),
g AS (SELECT series_id, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS ts FROM e)
SELECT g.series_id, g.ts, {r('h.temp')} AS temp, h.precip FROM g LEFT JOIN h ON h.series_id = g.series_id AND h.ts = g.ts""",
)
def calendar_grid(spark, folder):
    panel = hourly_panel(spark, folder).select("series_id", "ts", "temp", "precip")
    return densify(panel, HOURLY).select("series_id", "ts", rounded("temp"), "precip")


@query(
    "wn14_grid_lag",
    f"""WITH {HOURLY_SQL}, e AS (SELECT series_id, min(ts) AS a, max(ts) AS z FROM h GROUP BY 1),
g AS (SELECT series_id, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS ts FROM e),
f AS (SELECT g.series_id, g.ts, h.temp FROM g LEFT JOIN h ON h.series_id = g.series_id AND h.ts = g.ts)
SELECT series_id, ts, {r(f'lag(temp, 24) OVER ({SERIES})')} AS temp_lag24h FROM f""",
)
def grid_lag(spark, folder):
    """On the grid a lag of 24 rows is a lag of 24 hours."""
    grid = densify(hourly_panel(spark, folder).select("series_id", "ts", "temp"), HOURLY)
    return add_lags(grid, HOURLY, {"temp": (24,)}, "h").select("series_id", "ts", rounded("temp_lag24h"))


@query(
    "wn15_last_row",
    f"WITH {HOURLY_SQL} SELECT series_id, max(ts) AS ts, {r('max_by(temp, ts)')} AS temp, max_by(precip, ts) AS precip FROM h GROUP BY 1",
)
def last_row(spark, folder):
    panel = hourly_panel(spark, folder).select("series_id", "ts", "temp", "precip")
    return dedup.last_rows(panel, ["series_id"], "ts").select("series_id", "ts", rounded("temp"), "precip")


def hourly_feature_sql() -> str:
    pi = "2 * pi()"
    parts = [
        "year(ts)::INT AS year", "hour(ts)::INT AS hour", "(hour(ts) < 6)::INT AS is_night",
        *[f"{r(f'{f}({pi} * {part}(ts) / {period})')} AS {name}_{f}" for name, part, period in
          (("month", "month", 12), ("day", "dayofyear", 365), ("week", "week", 52), ("hour", "hour", 24)) for f in ("sin", "cos")],
        "(month(ts) IN (5, 6, 7, 8))::INT AS is_hot_month", "(month(ts) IN (12, 1, 2))::INT AS is_cool_month",
        "(month(ts) IN (5, 6, 7, 8, 9))::INT AS is_monsoon_season", "(month(ts) IN (11, 12, 1, 2, 3))::INT AS is_dry_season",
        f"{r('windspeed * windspeed', 4)} AS windspeed_sq", f"{r('sealevelpressure * humidity', 4)} AS pressure_humidity",
        lag_sql(HOURLY_LAGS, "h"),
        *[trailing_sql(c, "avg", n, f"{c}_roll_mean_{n}h", 4) for c in ("precip", "humidity") for n in (6, 24)],
        *[trailing_sql("windspeed", "max", n, f"windspeed_roll_max_{n}h", 4) for n in (3, 24)],
        rr("temp humidity windspeed sealevelpressure", 4), "precip", "winddir",
    ]
    return ", ".join(parts)


def daily_feature_sql() -> str:
    """The daily feature table, from a panel ``w`` that has the wind vector and the day length."""
    pi = "2 * pi()"
    seasons = [f"(month(ts) IN ({', '.join(map(str, months))}))::INT AS is_{name}" for name, months in DAILY_SEASONS.items()]
    rolls = [
        trailing_sql(c, {"mean": "avg", "std": "stddev_samp"}[statistic], n, f"{c}_roll_{statistic}_{n}", 4)
        for columns, statistic, sizes in DAILY_ROLLS for c in columns for n in sizes
    ]
    return ", ".join([
        "year(ts)::INT AS year", "(isodow(ts) IN (6, 7))::INT AS is_weekend",
        *[f"{r(f'{f}({pi} * {part}(ts) / {period})')} AS {name}_{f}" for name, part, period in
          (("month", "month", 12), ("day", "dayofyear", 365), ("week", "week", 52)) for f in ("sin", "cos")],
        *seasons, lag_sql(DAILY_LAGS), *rolls,
        f"{r('windspeed * windspeed', 4)} AS windspeed_sq", f"{r('sealevelpressure * humidity', 4)} AS pressure_humidity",
        f"{r('day_length_h * uvindex', 4)} AS daylength_uv", rr("temp day_length_h", 4), "uvindex", "winddir", "icon",
    ])


@query(
    "ud03_daily_features",
    f"""WITH {DAILY_SQL}, w AS (SELECT *, sin(radians(winddir)) AS winddir_sin, cos(radians(winddir)) AS winddir_cos,
  12 + (precip % 60 - winddir % 60) / 60 AS day_length_h FROM d) SELECT series_id, ts, {daily_feature_sql()} FROM w""",
)
def daily_features(spark, folder):
    """The whole daily feature table: 27 lags, 60 rolls, wind vector, day length from clock texts."""
    spec = daily_spec(DAILY)
    clock = lambda hour, minute: F.concat(F.lit(f"{hour}:"), F.lpad((F.col(minute) % 60).cast("int").cast("string"), 2, "0"))
    panel = daily_panel(spark, folder).withColumns({"sunrise": clock("06", "winddir"), "sunset": clock("18", "precip")})
    out = build_features(panel, spec)
    whole = {"year", "is_weekend", "uvindex", "winddir", *[f"is_{s}" for s in DAILY_SEASONS]}
    names = ["temp", *[c for c in feature_columns(out, spec) if c != "temp"]]
    return out.select(
        "series_id", "ts", "icon",
        *[F.col(c) if c in whole else rnd(c, 6 if c in ENCODED else 4).alias(c) for c in names],
    )


ENCODED = ("month_sin", "month_cos", "day_sin", "day_cos", "week_sin", "week_cos", "hour_sin", "hour_cos")


@query("ud03_hourly_features", f"WITH {HOURLY_SQL} SELECT series_id, ts, {hourly_feature_sql()} FROM h")
def hourly_features(spark, folder):
    """The whole hourly feature table of the specification: one window pass, one projection."""
    spec = hourly_spec(HOURLY)
    out = build_features(hourly_panel(spark, folder), spec)
    whole = {"year", "hour", "is_night", "precip", "winddir"}
    names = list(dict.fromkeys(["temp", *feature_columns(out, spec)]))
    return out.select(
        "series_id", "ts",
        *[F.col(c) if c in whole or c.startswith("is_") else rnd(c, 6 if c in ENCODED else 4).alias(c) for c in names],
    )
