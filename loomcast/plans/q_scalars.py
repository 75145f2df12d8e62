"""Queries over scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.functions import labels, numeric, temporal, text
from loomcast.learning import state
from loomcast.operators.chunks import DAILY
from loomcast.operators.dedup import last_rows
from loomcast.operators.windows import add_targets
from loomcast.plans.catalog import query, r, rnd, rounded
from loomcast.plans.panels import (
    DAILY_HORIZONS, DAILY_SQL, HOURLY_SQL, METRICS_SQL,
    daily_pairs, daily_panel, daily_splits, hourly_panel, pairs_sql, placed_sql,
)
from loomcast.operators.metrics import forecast_metrics
from loomcast.plans.q_joins import STATE_SQL
from loomcast.plans.q_rows import FORECAST_SQL, history_and_forecast
from loomcast.session import settled
from loomcast.sources.readers import table

CYCLES = (("month", "month", "month", 12), ("day", "day_of_year", "dayofyear", 365), ("week", "week_of_year", "week", 52), ("hour", "hour", "hour", 24))


@query(
    "sf01_cyclical",
    "SELECT event_id, "
    + ", ".join(f"{r(f'{f}(2 * pi() * {part}(ts) / {period})')} AS {name}_{f}" for name, _, part, period in CYCLES for f in ("sin", "cos"))
    + " FROM events",
)
def cyclical(spark, folder):
    parts = temporal.calendar_parts(F.col("ts"))
    out = []
    for name, part, _, period in CYCLES:
        sine, cosine = temporal.cyclical(parts[part], period)
        out += [rnd(sine, 6).alias(f"{name}_sin"), rnd(cosine, 6).alias(f"{name}_cos")]
    return table(spark, folder, "events").select("event_id", *out)


@query(
    "sf02_wind_vector",
    f"WITH {DAILY_SQL} SELECT series_id, ts, winddir, {r('sin(radians(winddir))')} AS winddir_sin, {r('cos(radians(winddir))')} AS winddir_cos FROM d",
)
def wind_vector(spark, folder):
    sine, cosine = temporal.direction_vector(F.col("winddir"))
    panel = daily_panel(spark, folder)
    return panel.select("series_id", "ts", "winddir", rnd(sine, 6).alias("winddir_sin"), rnd(cosine, 6).alias("winddir_cos"))


@query(
    "sf03_calendar_parts",
    """SELECT l_orderkey, l_linenumber, year(l_shipdate)::INT AS year, month(l_shipdate)::INT AS month, dayofyear(l_shipdate)::INT AS day_of_year,
  week(l_shipdate)::INT AS week_of_year, hour(l_shipdate)::INT AS hour, (isodow(l_shipdate) - 1)::INT AS day_of_week FROM lineitem""",
)
def calendar_parts(spark, folder):
    parts = temporal.calendar_parts(F.col("l_shipdate"))
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in parts.items()])


@query("sf04_day_flags", "SELECT event_id, (isodow(ts) >= 6)::INT AS is_weekend, (hour(ts) < 6)::INT AS is_night FROM events")
def day_flags(spark, folder):
    ts = F.col("ts")
    return table(spark, folder, "events").select("event_id", temporal.is_weekend(ts).alias("is_weekend"), temporal.is_night(ts).alias("is_night"))


SEASONS = {**temporal.DAILY_SEASONS, **temporal.HOURLY_SEASONS}


@query(
    "sf05_season_flags",
    "SELECT o_orderkey, " + ", ".join(f"(month(o_orderdate) IN {ms})::INT AS is_{n}" for n, ms in SEASONS.items()) + " FROM orders",
)
def season_flags(spark, folder):
    flags = temporal.season_flags(F.col("o_orderdate"), SEASONS)
    return table(spark, folder, "orders").select("o_orderkey", *[c.alias(n) for n, c in flags.items()])


@query(
    "sf06_day_length",
    f"""SELECT event_type AS series_id, date_trunc('day', ts) AS ts,
  CASE WHEN event_type <> 'error' THEN {r("date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts))) / 3600.0")} END AS day_length_h
FROM events GROUP BY 1, 2, event_type""",
)
def day_length(spark, folder):
    """First and last event of a day as clock texts; one series has texts that cannot be read."""
    days = table(spark, folder, "events").groupBy(
        F.col("event_type").alias("series_id"), F.col("ts").cast("date").cast("timestamp_ntz").alias("day")
    ).agg(F.date_format(F.min("ts"), "HH:mm:ss").alias("sunrise"), F.date_format(F.max("ts"), "HH:mm:ss").alias("sunset"))
    readable = days.withColumn("sunset", F.when(F.col("series_id") == "error", "n/a").otherwise(F.col("sunset")))
    return readable.select("series_id", F.col("day").alias("ts"), rnd(temporal.day_length_hours(F.col("sunrise"), F.col("sunset")), 6).alias("day_length_h"))


@query(
    "sf07_interactions",
    f"""WITH {DAILY_SQL} SELECT series_id, ts, {r('windspeed * windspeed')} AS windspeed_sq, {r('sealevelpressure * humidity', 4)} AS pressure_humidity,
  {r('tempmax * humidity')} AS feelslike_humidity_int, {r('tempmin * windspeed')} AS windchill_int FROM d""",
)
def interactions(spark, folder):
    """``daylength_uv`` is left out because the panel has no day length."""
    panel = daily_panel(spark, folder).withColumnsRenamed({"tempmax": "feelslikemax", "tempmin": "feelslikemin"})
    made = {**numeric.interactions(panel.columns), **numeric.exploratory_interactions(panel.columns)}
    digits = {"pressure_humidity": 4}
    return panel.select("series_id", "ts", *[rnd(c, digits.get(n, 6)).alias(n) for n, c in made.items()])


def _impute_case(column: str) -> str:
    return f"CASE WHEN precip > 1 THEN {column} END"


@query(
    "sf08_impute_and_clip",
    f"""WITH {HOURLY_SQL}, p AS (SELECT series_id, ts, {_impute_case('temp')} AS temp FROM h), m AS (SELECT avg(temp) AS m FROM p),
f AS (SELECT series_id, ts, coalesce(temp, m) AS temp FROM p, m),
q AS (SELECT quantile_cont(temp, 0.25) AS q1, quantile_cont(temp, 0.75) AS q3 FROM f)
SELECT series_id, ts, {r('greatest(least(temp, q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1))')} AS temp FROM f, q""",
)
def impute_and_clip(spark, folder):
    """Hours with a single event count as missing and are filled with the mean before clipping."""
    panel = hourly_panel(spark, folder)
    rows = settled(panel.select("series_id", "ts", F.when(F.col("precip") > 1, F.col("temp")).alias("temp")), "gaps")
    (s,) = state.fit_state(rows, ["temp"], strategy="mean")
    clipped = numeric.impute_and_clip(F.col("temp"), F.lit(s.centre), F.lit(s.lower), F.lit(s.upper))
    return rows.withColumn("temp", rnd(clipped, 6))


@query(
    "sf09_standardise",
    f"""{STATE_SQL}, c AS (SELECT *, greatest(least(coalesce(humidity, m), q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1)) AS v FROM splits, q),
s AS (SELECT avg(v) AS mean, stddev_pop(v) AS std FROM c WHERE split = 'train')
SELECT series_id, ts, split, {r('(v - mean) / std')} AS humidity FROM c, s""",
)
def standardise(spark, folder):
    rows = settled(daily_splits(spark, folder, "humidity").select("series_id", "ts", "split", "humidity"), "humidity")
    fitted = state.fit_state(rows.where("split = 'train'"), ["humidity"])
    return state.apply_state(rows, fitted).select("series_id", "ts", "split", rounded("humidity"))


@query(
    "sf10_one_hot",
    f"""WITH {DAILY_SQL} SELECT series_id, ts, (coalesce(icon, 'none') = 'clear-day')::DOUBLE AS "icon_clear-day",
  (coalesce(icon, 'none') = 'cloudy')::DOUBLE AS icon_cloudy, (coalesce(icon, 'none') = 'none')::DOUBLE AS icon_none,
  (coalesce(icon, 'none') = 'rain')::DOUBLE AS icon_rain FROM d""",
)
def one_hot(spark, folder):
    rows = settled(daily_splits(spark, folder, "icon").select("series_id", "ts", "split", "icon"), "icons")
    categories = state.train_categories(rows.where("split = 'train'"), "icon")
    return state.one_hot(rows, "icon", categories).drop("split")


@query(
    "sf11_ordinal",
    """SELECT event_id, CASE WHEN event_type < 'purchase' THEN
  (SELECT count(DISTINCT e.event_type) FROM events e WHERE e.event_type < events.event_type)::INT ELSE -1 END AS event_type_code FROM events""",
)
def ordinal(spark, folder):
    """Types from ``purchase`` on are unknown to the encoding."""
    events = table(spark, folder, "events")
    known = events.where(F.col("event_type") < "purchase")
    return state.ordinal(events, "event_type", known).select("event_id", "event_type_code")


@query(
    "sf12_confidence_interval",
    f"""WITH {DAILY_SQL}, {placed_sql('d')}, {pairs_sql(DAILY_HORIZONS)}, {METRICS_SQL}
SELECT series_id, ts, horizon, round_even(yhat - 1.96 * rmse, 1) + 0.0 AS lower, round_even(yhat + 1.96 * rmse, 1) + 0.0 AS upper,
  round_even(yhat + 2.576 * rmse, 1) + 0.0 AS upper_99 FROM pairs JOIN metrics USING (horizon) WHERE split = 'test'""",
)
def confidence_interval(spark, folder):
    pairs = settled(daily_pairs(spark, folder).where("split = 'test'"), "pairs")
    rows = pairs.join(F.broadcast(forecast_metrics(pairs).select("horizon", "rmse")), "horizon")
    lower, upper = numeric.confidence_interval(F.col("yhat"), F.col("rmse"))
    _, wide = numeric.confidence_interval(F.col("yhat"), F.col("rmse"), 0.99)
    return rows.select("series_id", "ts", "horizon", lower.alias("lower"), upper.alias("upper"), wide.alias("upper_99"))


@query("sf13_display_rounding", "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 4, 1) + 0.0 AS shown FROM lineitem")
def display_rounding(spark, folder):
    """Quarters: .25 and .75 go to the even digit."""
    items = table(spark, folder, "lineitem")
    return items.select("l_orderkey", "l_linenumber", numeric.display(F.col("l_quantity") / 4, 1).alias("shown"))


@query(
    "sf14_forecast_stamps",
    f"""WITH {HOURLY_SQL}, n AS (SELECT series_id, max(ts) AS ts FROM h GROUP BY 1)
SELECT series_id, horizon, ts + to_hours(horizon) AS forecast_ts, ts + to_days(horizon) AS forecast_day, 't+' || horizon || 'h' AS target
FROM n, (SELECT unnest(range(1, 25))::INT AS horizon)""",
)
def forecast_stamps(spark, folder):
    newest = last_rows(hourly_panel(spark, folder).select("series_id", "ts"), ["series_id"], "ts")
    steps = newest.select("series_id", "ts", F.explode(F.sequence(F.lit(1), F.lit(24))).alias("horizon"))
    h = F.col("horizon")
    return steps.select(
        "series_id",
        "horizon",
        temporal.forecast_time(F.col("ts"), h, "HOUR").alias("forecast_ts"),
        temporal.forecast_time(F.col("ts"), h, "DAY").alias("forecast_day"),
        temporal.horizon_label(h, "h").alias("target"),
    )


def _case(expression: str, levels) -> str:
    body = " ".join(f"WHEN {expression} < {b} THEN '{t}'" for b, t in levels[:-1])
    return f"CASE WHEN {expression} IS NULL THEN 'Unknown' {body} ELSE '{levels[-1][1]}' END"


@query(
    "sf15_range_labels",
    f"""WITH v AS (SELECT event_id, CASE WHEN value < 90 THEN value / 5 END AS uv, value AS risk, (event_id % 1000) / 1000.0::DOUBLE AS phase FROM events)
SELECT event_id, {_case('uv', labels.UV_LEVELS)} AS uv_level, {_case('risk', labels.RISK_LEVELS)} AS risk_level,
  CASE WHEN phase > 0.95 THEN 'New Moon' ELSE {_case('phase', labels.MOON_PHASES)} END AS moon FROM v""",
)
def range_labels(spark, folder):
    value = F.col("value")
    return table(spark, folder, "events").select(
        "event_id",
        labels.uv_level(F.when(value < 90, value / 5)).alias("uv_level"),
        labels.risk_level(value).alias("risk_level"),
        labels.moon_phase((F.col("event_id") % 1000) / F.lit(1000.0)).alias("moon"),
    )


@query(
    "sf16_compass",
    f"""WITH {DAILY_SQL} SELECT series_id, ts, winddir,
  ['N','NE','E','SE','S','SW','W','NW'][(floor((winddir + 22.5) / 45)::INT % 8) + 1] AS compass FROM d""",
)
def compass(spark, folder):
    return daily_panel(spark, folder).select("series_id", "ts", "winddir", labels.compass_point(F.col("winddir")).alias("compass"))


@query(
    "sf17_code_labels",
    f"""WITH {DAILY_SQL} SELECT series_id, ts, CASE icon WHEN 'clear-day' THEN 'Clear Sky' WHEN 'rain' THEN 'Rainy' WHEN 'cloudy' THEN 'Cloudy'
  ELSE CASE WHEN precip > 8 THEN 'Rainy' WHEN precip > 4 THEN 'Thunderstorm' ELSE 'Fair Weather' END END AS label FROM d""",
)
def code_labels(spark, folder):
    """Rows without an icon fall back to keywords of the conditions text."""
    conditions = F.when(F.col("precip") > 8, "Heavy RAIN").when(F.col("precip") > 4, "Thunder nearby").otherwise("calm")
    return daily_panel(spark, folder).select("series_id", "ts", labels.weather_text(F.col("icon"), conditions).alias("label"))


@query(
    "sf18_forecast_defaults",
    f"""WITH {FORECAST_SQL} SELECT series_id, ts, {r('temp')} AS temp, coalesce(precip, 0) AS precip, {r('temp + 2')} AS tempmax, {r('temp - 2')} AS tempmin,
  {r('temp - 5')} AS dew, 70.0::DOUBLE AS humidity, 'AI Forecast' AS conditions FROM both_rows WHERE is_forecast""",
)
def forecast_defaults(spark, folder):
    history, forecast = history_and_forecast(spark, folder)
    both = history.unionByName(forecast, allowMissingColumns=True).where("is_forecast")
    filled = labels.fill_forecast_defaults(both)
    return filled.select("series_id", "ts", *[rounded(c) for c in ("temp", "tempmax", "tempmin", "dew")], "precip", "humidity", "conditions")


@query(
    "sf19_time_texts",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%H:%M') AS clock,
  monthname(ts) AS month, dayname(ts) AS weekday, CASE WHEN event_type = 'error' THEN 'n/a' ELSE strftime(ts, '%H:%M') END AS sunrise FROM events""",
)
def time_texts(spark, folder):
    raw = F.when(F.col("event_type") == "error", "n/a").otherwise(F.date_format("ts", "HH:mm:ss"))
    return table(spark, folder, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        temporal.iso_text(F.col("ts")).alias("iso"),
        F.date_format("ts", "HH:mm").alias("clock"),
        F.date_format("ts", "MMMM").alias("month"),
        F.date_format("ts", "EEEE").alias("weekday"),
        temporal.clock_text(raw).alias("sunrise"),
    )


@query("sf20_iso_check", "SELECT event_id, event_type NOT IN ('error', 'view') AS valid FROM events")
def iso_check(spark, folder):
    """Times as text, with a trailing Z for some types and broken for two."""
    iso = temporal.iso_text(F.col("ts"))
    kind = F.col("event_type")
    given = F.when(kind == "error", F.date_format("ts", "dd/MM/yyyy")).when(kind == "view", F.concat(iso, F.lit("oops"))).when(
        kind == "click", F.concat(iso, F.lit("Z"))
    ).otherwise(iso)
    return table(spark, folder, "events").select("event_id", temporal.is_iso_timestamp(given).alias("valid"))


LONG_SQL = f"""WITH {DAILY_SQL}, t AS (SELECT series_id, ts, horizon, lead(temp, horizon) OVER (PARTITION BY series_id, horizon ORDER BY ts) AS y
  FROM d, (SELECT unnest(range(1, 6))::INT AS horizon))"""


@query("sf21_horizon_from_name", f"{LONG_SQL} SELECT horizon, count(y) AS n, {r('avg(y)')} AS mean FROM t GROUP BY 1")
def horizon_from_name(spark, folder):
    """Target columns unpivoted; the horizon is read from the column name."""
    wide = add_targets(daily_panel(spark, folder).select("series_id", "ts", "temp"), DAILY, "temp", DAILY_HORIZONS)
    names = [c for c in wide.columns if c.startswith("target_")]
    long = wide.select("series_id", "ts", *[F.col(f"`{c}`") for c in names]).unpivot(["series_id", "ts"], [F.col(f"`{c}`") for c in names], "name", "y")
    return long.groupBy(horizon_of("name")).agg(F.count("y").alias("n"), rnd(F.avg("y"), 6).alias("mean"))


def horizon_of(column: str):
    return temporal.horizon_number(F.col(column)).alias("horizon")


@query(
    "sf22_long_and_wide",
    f"""{LONG_SQL} SELECT series_id, ts, {', '.join(f"{r(f'max(y) FILTER (WHERE horizon = {h})')} AS h{h}" for h in DAILY_HORIZONS)} FROM t GROUP BY 1, 2""",
)
def long_and_wide(spark, folder):
    """Wide targets to long rows and back by pivot."""
    wide = add_targets(daily_panel(spark, folder).select("series_id", "ts", "temp"), DAILY, "temp", DAILY_HORIZONS)
    pairs = [F.struct(F.lit(h).alias("horizon"), F.col(f"`target_temp_t+{h}`").alias("y")) for h in DAILY_HORIZONS]
    long = wide.select("series_id", "ts", F.inline(F.array(*pairs)))
    back = long.groupBy("series_id", "ts").pivot("horizon", list(DAILY_HORIZONS)).agg(F.max("y"))
    return back.select("series_id", "ts", *[rnd(f"`{h}`", 6).alias(f"h{h}") for h in DAILY_HORIZONS])


@query(
    "sf23_reply_to_record",
    """SELECT event_id, CASE event_type WHEN 'click' THEN props::VARCHAR WHEN 'view' THEN props::VARCHAR
  WHEN 'error' THEN to_json({'raw': '[' || event_id || ']'})::VARCHAR ELSE to_json({'raw': 'reply ' || event_id || ' {'})::VARCHAR END AS record
FROM (SELECT event_id, event_type, replace(props, ' ', '') AS props FROM events)""",
)
def reply_to_record(spark, folder):
    """Replies: fenced object, bare object, an array, and text that is no JSON."""
    kind, body = F.col("event_type"), F.col("props")
    reply = (
        F.when(kind == "click", F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(kind == "view", body)
        .when(kind == "error", F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit("]")))
        .otherwise(F.concat(F.lit("reply "), F.col("event_id").cast("string"), F.lit(" {")))
    )
    return table(spark, folder, "events").select("event_id", text.parse_reply(reply).alias("record"))


@query(
    "sf24_diurnal_curve",
    f"""WITH {DAILY_SQL} SELECT series_id, ts + to_hours(hour) AS ts,
  {r('(tempmax + tempmin) / 2 + CASE WHEN tempmax > tempmin THEN (tempmax - tempmin) / 2 ELSE 1.0 END * sin((hour - 14) / 24.0 * 2 * pi())')} AS temp
FROM d, (SELECT unnest(range(0, 24))::INT AS hour)""",
)
def diurnal_curve(spark, folder):
    days = daily_panel(spark, folder).select("series_id", "ts", "tempmin", "tempmax")
    hours = days.select("*", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    return hours.select(
        "series_id",
        F.timestamp_add("HOUR", F.col("hour"), F.col("ts")).alias("ts"),
        rnd(numeric.diurnal_curve(F.col("tempmin"), F.col("tempmax"), F.col("hour")), 6).alias("temp"),
    )


@query(
    "sf25_first_present",
    f"WITH {FORECAST_SQL} SELECT series_id, ts, is_forecast, {r('coalesce(precip, temp, 0)')} AS gust, coalesce(precip, 0) AS dew FROM both_rows",
)
def first_present(spark, folder):
    history, forecast = history_and_forecast(spark, folder)
    both = history.unionByName(forecast, allowMissingColumns=True)
    return both.select(
        "series_id", "ts", "is_forecast", rnd(F.coalesce("precip", "temp", F.lit(0.0)), 6).alias("gust"), F.nvl(F.col("precip"), F.lit(0.0)).alias("dew")
    )
