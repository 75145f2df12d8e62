"""Queries over joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.functions.numeric import impute_and_clip
from loomcast.learning import registry, state
from loomcast.operators import dedup, filters
from loomcast.operators.chunks import DAILY
from loomcast.operators.decompose import decompose
from loomcast.operators.metrics import forecast_metrics, winners
from loomcast.operators.windows import add_lags, add_targets
from loomcast.plans.catalog import query, r, rnd, rounded, rr
from loomcast.plans.panels import (
    DAILY_HORIZONS, DAILY_SQL, HOURLY_SQL, METRICS_SQL,
    daily_pairs, daily_panel, daily_splits, hourly_panel, pairs_sql, placed_sql,
)
from loomcast.plans.q_scores import RANK_SCORES, SCORES_SQL, TRIALS_SQL, feature_scores, naive_trials
from loomcast.session import settled
from loomcast.sources.readers import table


@query(
    "jn01_features_with_targets",
    f"""WITH {DAILY_SQL} SELECT series_id, ts, {r('lag(temp, 1) OVER w')} AS temp_lag1, {r('lead(temp, 1) OVER w')} AS y
FROM d WINDOW w AS (PARTITION BY series_id ORDER BY ts)""",
)
def features_with_targets(spark, folder):
    """Two tables paired by series and time rather than by row order."""
    panel = settled(daily_panel(spark, folder).select("series_id", "ts", "temp"), "daily")
    x = add_lags(panel, DAILY, {"temp": (1,)}).select("series_id", "ts", "temp_lag1")
    y = add_targets(panel, DAILY, "temp", (1,)).select("series_id", "ts", F.col("`target_temp_t+1`").alias("y"))
    return x.join(y, ["series_id", "ts"]).select("series_id", "ts", rounded("temp_lag1"), rounded("y"))


@query("jn02_align_scores", f"{SCORES_SQL} SELECT feature, {rr('correlation mutual_info long_correlation')} FROM scores")
def align_scores(spark, folder):
    """Score vectors side by side; a feature one of them lacks is kept with a null."""
    return feature_scores(spark, folder).select("feature", *[rounded(c) for c in RANK_SCORES])


@query(
    "jn03_predictions_with_metrics",
    f"""WITH {DAILY_SQL}, {placed_sql('d')}, {pairs_sql(DAILY_HORIZONS)}, {METRICS_SQL}
SELECT p.series_id, p.ts, p.horizon, {r('p.yhat')} AS yhat, {r('m.rmse')} AS rmse, {r('m.r2')} AS r2
FROM pairs p LEFT JOIN metrics m USING (horizon) WHERE p.split = 'test'""",
)
def predictions_with_metrics(spark, folder):
    pairs = settled(daily_pairs(spark, folder).where("split = 'test'"), "pairs")
    # One row per horizon on the right: small by construction.
    joined = pairs.join(F.broadcast(forecast_metrics(pairs).select("horizon", "rmse", "r2")), "horizon", "left")
    return joined.select("series_id", "ts", "horizon", rounded("yhat"), rounded("rmse"), rounded("r2"))


@query(
    "jn04_tuned_configuration",
    f"""{TRIALS_SQL}, best AS (
  SELECT horizon, model, params FROM trials QUALIFY row_number() OVER (PARTITION BY horizon ORDER BY rmse, model, params) = 1),
stage AS (SELECT model, params FROM trials WHERE horizon = 12 QUALIFY row_number() OVER (ORDER BY rmse, model, params) = 1)
SELECT g.horizon, coalesce(b.model, s.model) AS model, coalesce(b.params, s.params) AS params,
  CASE WHEN b.model IS NOT NULL THEN 'horizon' ELSE 'first stage' END AS source
FROM (SELECT unnest(range(1, 31))::INT AS horizon) g LEFT JOIN best b USING (horizon) CROSS JOIN stage s""",
)
def tuned_configuration(spark, folder):
    """Thirty horizons are asked for; the trials end at 24, and those beyond take the middle one's."""
    trials = settled(naive_trials(spark, folder), "trials")
    horizons = spark.range(1, 31).select(F.col("id").cast("int").alias("horizon"))
    return registry.resolve_configs(horizons, winners(trials), winners(trials.where("horizon = 12")), "Persistence")


@query(
    "jn05_predictions_with_actuals",
    f"""WITH {HOURLY_SQL}, p AS (
  SELECT series_id, ts, horizon, ts + to_hours(horizon) AS forecast_ts, temp AS yhat
  FROM h, (SELECT unnest([1, 6, 24])::INT AS horizon))
SELECT p.series_id, p.ts, p.horizon, p.forecast_ts, {r('p.yhat')} AS yhat, {r('a.temp')} AS y
FROM p JOIN h a ON a.series_id = p.series_id AND a.ts = p.forecast_ts""",
)
def predictions_with_actuals(spark, folder):
    """Forecasts stored with their label time, met by the observation of that time."""
    panel = hourly_panel(spark, folder).select("series_id", "ts", "temp")
    made = panel.select(
        "series_id", "ts", F.explode(F.array(F.lit(1), F.lit(6), F.lit(24))).alias("horizon"), F.col("temp").alias("yhat")
    ).withColumn("forecast_ts", F.timestamp_add("HOUR", F.col("horizon"), F.col("ts")))
    actual = panel.select("series_id", F.col("ts").alias("forecast_ts"), F.col("temp").alias("y"))
    joined = made.join(actual, ["series_id", "forecast_ts"])
    return joined.select("series_id", "ts", "horizon", "forecast_ts", rounded("yhat"), rounded("y"))


STATE_SQL = f"""WITH {DAILY_SQL}, {placed_sql('d')},
q AS (SELECT quantile_cont(humidity, 0.25) AS q1, quantile_cont(humidity, 0.75) AS q3, median(humidity) AS m FROM splits WHERE split = 'train')"""


@query(
    "jn06_apply_state",
    f"""{STATE_SQL} SELECT series_id, ts, split,
  {r('greatest(least(coalesce(humidity, m), q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1))')} AS humidity FROM splits, q""",
)
def apply_state(spark, folder):
    """State fitted on the training rows, applied to every split."""
    rows = settled(daily_splits(spark, folder, "humidity").select("series_id", "ts", "split", "humidity"), "humidity")
    (fitted,) = state.fit_state(rows.where("split = 'train'"), ["humidity"])
    clipped = impute_and_clip(F.col("humidity"), F.lit(fitted.centre), F.lit(fitted.lower), F.lit(fitted.upper))
    return rows.withColumn("humidity", rnd(clipped, 6))


@query(
    "jn07_season_to_rows",
    f"""WITH {DAILY_SQL}, n AS (SELECT series_id, ts, temp, (row_number() OVER w - 1) % 7 AS phase,
  CASE WHEN count(temp) OVER f = 7 THEN avg(temp) OVER f END AS trend
  FROM d WINDOW w AS (PARTITION BY series_id ORDER BY ts),
    f AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
m AS (SELECT series_id, phase, avg(temp - trend) AS s FROM n GROUP BY 1, 2),
c AS (SELECT series_id, phase, s - avg(s) OVER (PARTITION BY series_id) AS seasonal FROM m)
SELECT series_id, ts, phase::INT AS phase, {r('seasonal')} AS seasonal FROM n JOIN c USING (series_id, phase)""",
)
def season_to_rows(spark, folder):
    out = decompose(daily_panel(spark, folder).select("series_id", "ts", "temp"), DAILY)
    return out.select("series_id", "ts", "phase", rounded("seasonal"))


@query(
    "jn08_only_new_rows",
    f"WITH {HOURLY_SQL} SELECT series_id, ts, {r('temp')} AS temp FROM h WHERE ts >= TIMESTAMP '2024-01-25'",
)
def only_new_rows(spark, folder):
    """The whole panel arrives again; what was stored before the 25th is not taken twice."""
    panel = hourly_panel(spark, folder).select("series_id", "ts", "temp")
    stored = hourly_panel(spark, folder, before="2024-01-25").select("series_id", "ts")
    return dedup.only_new(panel, stored, ["series_id", "ts"]).select("series_id", "ts", rounded("temp"))


@query(
    "jn09_enough_history",
    """WITH u AS (SELECT user_id, date_trunc('day', ts) AS ts, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, ts, n FROM u WHERE user_id IN (SELECT user_id FROM u GROUP BY 1 HAVING count(*) >= 24)""",
)
def enough_history(spark, folder):
    """Series are users here; those active on fewer than 24 days are left out."""
    daily = table(spark, folder, "events").groupBy("user_id", F.col("ts").cast("date").cast("timestamp_ntz").alias("ts")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return filters.series_with_history(daily, ["user_id"], 24)
