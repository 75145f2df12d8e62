"""Queries over projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.functions import text
from loomcast.functions.numeric import finite_frame
from loomcast.operators import filters, split
from loomcast.operators.chunks import HOURLY, over_chunks
from loomcast.operators.dedup import merge_history_and_forecast
from loomcast.operators.windows import add_lags, lag_columns
from loomcast.plans.catalog import query, r, rnd, rounded, rr
from loomcast.plans.panels import DAILY_SQL, HOURLY_SQL, daily_panel, daily_splits, hourly_panel, placed_sql
from loomcast.plans.serving import LEAST_HOURS
from loomcast.session import settled
from loomcast.sources.readers import table
from loomcast.spec import LEAKAGE_COLUMNS, project_to_contract, hourly_spec, build_features


@query(
    "pr01_drop_leakage",
    f"WITH {DAILY_SQL} SELECT series_id, ts, {rr('temp humidity windspeed')}, {r('sealevelpressure', 4)} AS sealevelpressure, "
    f"precip, winddir, uvindex, {r('cloudcover')} AS cloudcover, {r('dew')} AS dew, icon FROM d",
)
def drop_leakage(spark, folder):
    """Names that are absent from the panel are ignored."""
    kept = daily_panel(spark, folder).drop(*LEAKAGE_COLUMNS)
    return kept.withColumns(
        {**{c: rnd(c, 6) for c in ("temp", "humidity", "windspeed", "cloudcover", "dew")}, "sealevelpressure": rnd("sealevelpressure", 4)}
    )


@query(
    "pr02_drop_encoded",
    f"WITH {HOURLY_SQL} SELECT series_id, ts, {r('sin(radians(winddir))')} AS winddir_sin, {r('cos(radians(winddir))')} AS winddir_cos FROM h",
)
def drop_encoded(spark, folder):
    """Raw columns go as the last step, after everything derived from them."""
    from loomcast.functions.temporal import direction_vector

    sine, cosine = direction_vector(F.col("winddir"))
    panel = hourly_panel(spark, folder).select("series_id", "ts", "winddir")
    return panel.withColumns({"winddir_sin": rnd(sine, 6), "winddir_cos": rnd(cosine, 6)}).drop("winddir")


CONTRACT = ("temp_lag1h", "precip_roll_mean_6h", "windspeed_sq", "is_night")


@query(
    "pr03_contract_projection",
    f"""WITH {HOURLY_SQL} SELECT series_id, ts, {r('lag(temp, 1) OVER w')} AS temp_lag1h,
  {r('CASE WHEN count(precip) OVER f = 6 THEN avg(precip) OVER f END')} AS precip_roll_mean_6h,
  {r('windspeed * windspeed')} AS windspeed_sq, (hour(ts) < 6)::INT AS is_night
FROM h WINDOW w AS (PARTITION BY series_id ORDER BY ts),
  f AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)""",
)
def contract_projection(spark, folder):
    """The model's features in the model's order out of the full hourly feature table."""
    spec = hourly_spec(HOURLY)
    out = project_to_contract(build_features(hourly_panel(spark, folder), spec), spec, CONTRACT)
    return out.withColumns({c: rnd(c, 6) for c in CONTRACT[:3]})


@query(
    "pr04_numeric_columns",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
)
def numeric_columns(spark, folder):
    items = table(spark, folder, "lineitem")
    return items.select(*filters.columns_of_kind(items, numeric=True))


@query(
    "pr05_non_finite",
    "SELECT event_id, CASE WHEN value >= 5 AND value <= 50 THEN value END AS value FROM events",
)
def non_finite(spark, folder):
    """Small values are made NaN and large ones infinite first, so that there is something to clean."""
    value = (
        F.when(F.col("value") < 5, F.lit(float("nan"))).when(F.col("value") > 50, F.lit(float("inf"))).otherwise(F.col("value"))
    )
    return finite_frame(table(spark, folder, "events").select("event_id", value.alias("value")))


@query(
    "pr06_mask_fields",
    """SELECT event_id, to_json({'event_id': event_id, 'event_type': event_type, 'user_id': user_id})::VARCHAR AS record FROM events""",
)
def mask_fields(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "user_id", F.col("value").alias("temp"))
    return events.select("event_id", text.masked_record(events).alias("record"))


@query(
    "pr07_canonical_record",
    """SELECT o_orderkey, to_json({'conditions': o_orderpriority, 'humidity': o_custkey, 'precip': NULL, 'preciptype':
  CASE WHEN o_orderstatus = 'F' THEN 'rain' END})::VARCHAR AS record FROM orders""",
)
def canonical_record(spark, folder):
    """Fixed keys in fixed order; an absent column and a null are both null."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("conditions"),
        F.col("o_custkey").alias("humidity"),
        F.when(F.col("o_orderstatus") == "F", "rain").alias("preciptype"),
    )
    keys = ("conditions", "humidity", "precip", "preciptype")
    return orders.select("o_orderkey", text.canonical_record(orders, keys).alias("record"))


@query(
    "fl01_drop_incomplete",
    f"""WITH {HOURLY_SQL}, f AS (SELECT series_id, ts, lag(temp, 24) OVER w AS temp_lag24h, lead(temp, 24) OVER w AS y
  FROM h WINDOW w AS (PARTITION BY series_id ORDER BY ts))
SELECT series_id, ts, {r('temp_lag24h')} AS temp_lag24h, {r('y')} AS y FROM f WHERE temp_lag24h IS NOT NULL AND y IS NOT NULL""",
)
def drop_incomplete(spark, folder):
    def build(w):
        return [*lag_columns(w, {"temp": (24,)}, "h"), F.lead("temp", 24).over(w).alias("y")]

    both = over_chunks(hourly_panel(spark, folder).select("series_id", "ts", "temp"), HOURLY, build, back=24, ahead=24)
    return both.dropna(subset=["temp_lag24h", "y"]).select("series_id", "ts", rounded("temp_lag24h"), rounded("y"))


@query(
    "fl02_drop_any_null",
    f"""WITH {DAILY_SQL}, f AS (SELECT series_id, ts, lag(temp, 7) OVER (PARTITION BY series_id ORDER BY ts) AS temp_lag7 FROM d)
SELECT series_id, ts, {r('temp_lag7')} AS temp_lag7 FROM f WHERE temp_lag7 IS NOT NULL""",
)
def drop_any_null(spark, folder):
    """Only the columns the model needs count; an unused ``icon`` that is null drops nothing."""
    from loomcast.operators.chunks import DAILY

    lagged = add_lags(daily_panel(spark, folder).select("series_id", "ts", "temp"), DAILY, {"temp": (7,)})
    return lagged.select("series_id", "ts", rounded("temp_lag7")).dropna()


@query(
    "fl03_drop_empty_columns",
    f"WITH {DAILY_SQL}, {placed_sql('d')} SELECT series_id, ts, split, precip FROM splits",
)
def drop_empty_columns(spark, folder):
    """``snow`` has values in the test rows only, so it goes everywhere."""
    rows = daily_splits(spark, folder, "precip").select(
        "series_id", "ts", "split", "precip", F.when(F.col("split") == "test", F.col("precip")).alias("snow")
    )
    return filters.drop_empty_columns(rows, ["precip", "snow"], F.col("split") == "train")


@query(
    "fl04_as_of",
    f"""WITH {HOURLY_SQL}, cut AS (SELECT * FROM h WHERE ts <= TIMESTAMP '2024-01-20 12:00:00')
SELECT series_id, ts, {r('temp')} AS temp FROM cut
WHERE series_id IN (SELECT series_id FROM cut GROUP BY 1 HAVING count(*) >= {LEAST_HOURS})""",
)
def as_of(spark, folder):
    panel = hourly_panel(spark, folder, before="2024-01-20 13:00:00").select("series_id", "ts", "temp")
    # Rows are counted and kept: read twice, so the panel is written once.
    cut = settled(filters.as_of(panel, "ts", "2024-01-20 12:00:00"), "as-of")
    return filters.series_with_history(cut, ["series_id"], LEAST_HOURS).select("series_id", "ts", rounded("temp"))


@query(
    "fl05_history_filter",
    f"""WITH {DAILY_SQL} SELECT series_id, ts, {r('temp')} AS temp FROM d
WHERE ts >= TIMESTAMP '1996-03-01' AND ts < TIMESTAMP '1998-09-01' AND monthname(ts) = 'March' AND year(ts) = 1997""",
)
def history_filter(spark, folder):
    panel = daily_panel(spark, folder)
    kept = filters.history_filter(panel, "ts", "1996-03-01", "1998-08-31", "March", 1997)
    return kept.select("series_id", "ts", rounded("temp"))


@query(
    "fl06_date_lookup",
    f"""WITH {HOURLY_SQL}, day AS (SELECT * FROM h WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16')
SELECT series_id, 'first' AS pick, min(ts) AS ts, {r('min_by(temp, ts)')} AS temp FROM day GROUP BY 1
UNION ALL SELECT series_id, 'last', max(ts), {r('max_by(temp, ts)')} FROM day GROUP BY 1""",
)
def date_lookup(spark, folder):
    day = hourly_panel(spark, folder, "2024-01-15", "2024-01-16").select("series_id", "ts", "temp")
    panel = settled(day, "one-day")
    parts = [
        filters.first_of_date(panel, ["series_id"], "ts", "2024-01-15", last).withColumn("pick", F.lit(name))
        for name, last in (("first", False), ("last", True))
    ]
    return parts[0].unionByName(parts[1]).select("series_id", "pick", "ts", rounded("temp"))


@query(
    "fl07_time_lookup",
    """WITH e AS (SELECT event_type, ts, min(value) AS value FROM events GROUP BY 1, 2),
m AS (SELECT event_type, date_trunc('minute', ts) AS minute, min_by(value, ts) AS value FROM e GROUP BY 1, 2),
q AS (SELECT event_id, event_type, date_trunc('second', ts) AS ts FROM events)
SELECT event_id, q.event_type, q.ts, coalesce(e.value, m.value) AS found_value, e.value IS NOT NULL AS exact
FROM q LEFT JOIN e ON e.event_type = q.event_type AND e.ts = q.ts
LEFT JOIN m ON m.event_type = q.event_type AND m.minute = date_trunc('minute', q.ts)""",
)
def time_lookup(spark, folder):
    """Every event asks for its time cut to the second, which mostly exists only to the minute."""
    events = table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    asked = events.select("event_id", "event_type", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"))
    return filters.lookup_time(asked, events.drop("event_id"), ["event_type"], "ts", "value")


def history_and_forecast(spark, folder):
    """Hourly history, and each row moved one day ahead as a forecast."""
    history = hourly_panel(spark, folder).select("series_id", "ts", "temp", "precip", F.lit(False).alias("is_forecast"))
    ahead = F.col("ts") + F.expr("INTERVAL 24 HOURS")
    forecast = history.select("series_id", ahead.alias("ts"), (F.col("temp") + 0.5).alias("temp"), F.lit(True).alias("is_forecast"))
    return history, forecast


FORECAST_SQL = f"""{HOURLY_SQL},
both_rows AS (SELECT series_id, ts, temp, precip, FALSE AS is_forecast FROM h
  UNION ALL SELECT series_id, ts + INTERVAL 24 HOUR, temp + 0.5, NULL, TRUE FROM h),
merged AS (SELECT * FROM both_rows QUALIFY row_number() OVER (PARTITION BY series_id, ts ORDER BY is_forecast DESC) = 1)"""


@query("fl08_history_flag", f"WITH {FORECAST_SQL} SELECT series_id, ts, {r('temp')} AS temp, precip FROM merged WHERE NOT is_forecast")
def history_flag(spark, folder):
    merged = merge_history_and_forecast(*history_and_forecast(spark, folder), ["series_id", "ts"])
    return merged.where(~F.col("is_forecast")).select("series_id", "ts", rounded("temp"), "precip")


@query(
    "fl09_hashed_split",
    """SELECT o_orderkey, CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'dev' ELSE 'test' END AS split
FROM (SELECT o_orderkey, ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT % 100 AS b FROM orders)""",
)
def hashed_split(spark, folder):
    return split.hashed_split(table(spark, folder, "orders"), "o_orderkey").select("o_orderkey", "split")
