"""Queries over fitted state, selection, models and their records."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.functions.temporal import direction_vector
from loomcast.learning import models, registry, selection, state
from loomcast.operators.chunks import DAILY, over_chunks
from loomcast.operators.metrics import average_metrics, forecast_metrics, winners
from loomcast.operators.ranking import overlap
from loomcast.operators.split import split_label, split_targets
from loomcast.operators.windows import lag_columns
from loomcast.plans.catalog import query, r, rnd, rounded, rr
from loomcast.plans.forecast_job import JobConfig
from loomcast.plans.panels import (
    DAILY_HORIZONS, DAILY_SQL, HOURLY_HORIZONS, HOURLY_SQL, METRICS_SQL,
    daily_pairs, daily_panel, hourly_pairs, pairs_sql, placed_sql,
)
from loomcast.plans.q_scores import TRIALS_SQL, naive_summary, naive_trials
from loomcast.plans.q_lists import LISTS_SQL, _lists
from loomcast.session import settled
from loomcast.sources.readers import table
from loomcast.spec import daily_spec

FEATURES = ("temp_lag1", "temp_lag3", "temp_lag7", "humidity", "windspeed", "winddir_sin", "day_sin", "day_cos")


def supervised(spark, folder, horizons=DAILY_HORIZONS):
    """Daily features with bounded targets, named ``y1..``; incomplete lag rows are left out."""
    panel = daily_panel(spark, folder).select("series_id", "ts", "temp", "humidity", "windspeed", "winddir")
    lagged = split_targets(panel, DAILY, "temp", horizons, build=lambda w: lag_columns(w, {"temp": (1, 3, 7)}), back=7)
    sine, _ = direction_vector(F.col("winddir"))
    wide = lagged.withColumns({**daily_spec(DAILY).calendar_columns(), "winddir_sin": sine})
    labels = [F.col(f"`target_temp_t+{h}`").alias(f"y{h}") for h in horizons]
    rows = wide.select("series_id", "ts", "pos", "series_rows", "split", "temp", *FEATURES, *labels)
    # Written once: the many fits read the table, not the raw input.
    return settled(rows.dropna(subset=["temp_lag7"]), "supervised")


TARGETS = {h: f"y{h}" for h in DAILY_HORIZONS}
# The model that the forecast job falls back on.
DEFAULTS = {h: JobConfig.default_model for h in DAILY_HORIZONS}


@query(
    "ud01_iqr_clipper",
    f"""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01')
SELECT l_orderkey, l_linenumber, {r('greatest(least(l_extendedprice, q3 + 0.25 * (q3 - q1)), q1 - 0.25 * (q3 - q1))', 4)} AS l_extendedprice FROM lineitem, q""",
)
def iqr_clipper(spark, folder):
    """Estimator fitted on the early rows; tight fences, so that something is clipped."""
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    early = items.where(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    model = state.IqrClipper(inputCols=["l_extendedprice"], multiplier=0.25).fit(early)
    return model.transform(items).select("l_orderkey", "l_linenumber", rounded("l_extendedprice", 4))


ML03_SQL = f"""WITH {DAILY_SQL}, {placed_sql('d')}, f AS (SELECT *, lag(temp, 7) OVER (PARTITION BY series_id ORDER BY ts) AS temp_lag7 FROM splits),
med AS (SELECT median(humidity) AS mh, median(temp_lag7) AS mt FROM f WHERE split = 'train'),
filled AS (SELECT series_id, ts, split, icon, coalesce(humidity, mh) AS humidity, coalesce(temp_lag7, mt) AS temp_lag7 FROM f, med),
q AS (SELECT quantile_cont(humidity, 0.25) AS h1, quantile_cont(humidity, 0.75) AS h3, quantile_cont(temp_lag7, 0.25) AS t1, quantile_cont(temp_lag7, 0.75) AS t3
  FROM filled WHERE split = 'train'),
clipped AS (SELECT series_id, ts, split, icon, greatest(least(humidity, h3 + 1.5 * (h3 - h1)), h1 - 1.5 * (h3 - h1)) AS humidity,
  greatest(least(temp_lag7, t3 + 1.5 * (t3 - t1)), t1 - 1.5 * (t3 - t1)) AS temp_lag7 FROM filled, q),
mom AS (SELECT avg(humidity) AS ah, stddev_pop(humidity) AS sh, avg(temp_lag7) AS a7, stddev_pop(temp_lag7) AS s7 FROM clipped WHERE split = 'train')
SELECT series_id, ts, split, {r('(humidity - ah) / sh')} AS humidity, {r('(temp_lag7 - a7) / s7')} AS temp_lag7,
  (coalesce(icon, 'none') = 'none')::DOUBLE AS icon_none, (coalesce(icon, 'none') = 'rain')::DOUBLE AS icon_rain FROM clipped, mom"""


@query("ml03_preprocess", ML03_SQL)
def preprocess(spark, folder):
    """Median, fences, scaling and categories from the training rows, applied to all splits."""
    panel = daily_panel(spark, folder).select("series_id", "ts", "temp", "humidity", "icon")
    lagged = over_chunks(panel, DAILY, lambda w: lag_columns(w, {"temp": (7,)}), back=7, numbered=True)
    lagged = lagged.withColumn("split", split_label())
    rows = settled(lagged.select("series_id", "ts", "split", "icon", "humidity", "temp_lag7"), "raw-features")
    train = rows.where("split = 'train'")
    fitted = state.fit_state(train, ["humidity", "temp_lag7"])
    out = state.one_hot(state.apply_state(rows, fitted), "icon", state.train_categories(train, "icon"))
    return out.select("series_id", "ts", "split", rounded("humidity"), rounded("temp_lag7"), "icon_none", "icon_rain")


@query("ml01_feature_ranking")
def feature_ranking(spark, folder):
    train = supervised(spark, folder).where("split = 'train'")
    ranked = selection.score_features(train, FEATURES, "y1")
    return ranked.select("feature", *selection.SCORES, "mean_rank")


@query("ml02_feature_lists")
def feature_lists(spark, folder):
    train = supervised(spark, folder).where("split = 'train'")
    lists, _ = selection.select_lists(train, FEATURES, ["y1", "y5"], DAILY_HORIZONS, top_n=5)
    return lists


@query(
    "ml02_list_overlap",
    f"""{LISTS_SQL} SELECT 'combined' AS part, count(*) AS features FROM (FROM short UNION FROM long)
UNION ALL SELECT 'shared', count(*) FROM (FROM short INTERSECT FROM long)
UNION ALL SELECT 'short_only', count(*) FROM (FROM short EXCEPT FROM long)
UNION ALL SELECT 'long_only', count(*) FROM (FROM long EXCEPT FROM short)""",
)
def list_overlap(spark, folder):
    return overlap(*_lists(spark, folder))


@query("ag17_forest_importance")
def forest_importance(spark, folder):
    train = supervised(spark, folder).where("split = 'train'")
    return selection.forest_importance(train.where("y1 IS NOT NULL"), FEATURES, "y1")


@query("ml09_lasso_weights")
def lasso_weights(spark, folder):
    train = supervised(spark, folder).where("split = 'train' AND y1 IS NOT NULL")
    return selection.lasso_weights(train, FEATURES, "y1", folds=5)


@query("ml10_forest_scores")
def forest_scores(spark, folder):
    """Dev errors of a forest of 100 trees."""
    forest = {1: models.ModelConfig("RandomForest", {"numTrees": 100, "maxDepth": 4})}
    rows = supervised(spark, folder, (1,))
    model, _ = models.train_horizons(rows, FEATURES, {1: "y1"}, forest, splits=("train",))
    return forecast_metrics(models.score_split(model, rows, "dev", {1: "y1"}, ["series_id", "ts"]))


LASSO_SQL = f"""WITH {DAILY_SQL}, {placed_sql('d')}, f AS (SELECT *, lag(temp, 1) OVER w AS x, lag(temp, 7) OVER w AS temp_lag7,
  lead(temp, 1) OVER (PARTITION BY series_id, split ORDER BY ts) AS y FROM splits WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
t AS (SELECT x, y, least(floor(pos * 5 / (series_rows * 0.7::DOUBLE)), 4)::INT AS fold FROM f
  WHERE split = 'train' AND y IS NOT NULL AND temp_lag7 IS NOT NULL),
whole AS (SELECT covar_pop(x, y) AS c, var_pop(x) AS v FROM t),
p AS (SELECT i, abs(c) * pow(0.001::DOUBLE, i / 99) AS penalty FROM whole, (SELECT unnest(range(100)) AS i)),
rest AS (SELECT f.fold, covar_pop(x, y) AS c, var_pop(x) AS v, avg(x) AS mx, avg(y) AS my
  FROM (SELECT DISTINCT fold FROM t) f JOIN t ON t.fold <> f.fold GROUP BY 1),
w AS (SELECT fold, i, penalty, sign(c) * greatest(abs(c) - penalty, 0) / v AS w, mx, my FROM rest, p),
e AS (SELECT w.i, w.fold, avg(power(y - my - w * (x - mx), 2)) AS mse FROM w JOIN t USING (fold) GROUP BY 1, 2),
chosen AS (SELECT i FROM (SELECT i, avg(mse) AS mse FROM e GROUP BY 1) ORDER BY mse, i LIMIT 1)
SELECT 'temp_lag1' AS feature, {r('abs(sign(c) * greatest(abs(c) - penalty, 0) / v)')} AS lasso_coef FROM whole, p JOIN chosen USING (i)"""


@query("ml09_lasso_one_feature", LASSO_SQL)
def lasso_one_feature(spark, folder):
    """The whole path of 100 penalties and five folds of time, which SQL can follow for one feature."""
    train = supervised(spark, folder).where("split = 'train' AND y1 IS NOT NULL")
    return selection.lasso_weights(train, ["temp_lag1"], "y1", folds=5).select("feature", rounded("lasso_coef"))


# Trials per horizon of the registered searches, over the whole space, all families and horizons.
TRIALS, FIRST_TRIALS = 4, 5


def _searched(trials, *columns):
    """What is certain of a search: one row per horizon and trial, shares and errors in range."""
    return trials.groupBy(*columns, "horizon").agg(
        F.count(F.lit(1)).alias("trials"),
        F.count_if((F.col("rmse") > 0) & (F.col("mae") <= F.col("rmse")) & (F.col("share") > 0) & (F.col("share") <= 1)).alias("sound"),
        F.count_if(F.col("share") == 1).cast("boolean").alias("has_winner"),
    )


@query(
    "ml04_tuning_trials",
    f"SELECT unnest(range(1, 6))::INT AS horizon, {TRIALS}::BIGINT AS trials, {TRIALS}::BIGINT AS sound, true AS has_winner",
)
def tuning_trials(spark, folder):
    """The search of the forecast job: its whole space, every family, every horizon."""
    return _searched(models.tune_horizons(supervised(spark, folder), FEATURES, TARGETS, trials=TRIALS))


@query(
    "ml05_two_stage_tuning",
    f"""SELECT 'first' AS stage, 3::INT AS horizon, {FIRST_TRIALS}::BIGINT AS trials, {FIRST_TRIALS}::BIGINT AS sound, true AS has_winner, 3::BIGINT AS families
UNION ALL SELECT 'second', unnest(range(1, 6))::INT, {TRIALS}::BIGINT, {TRIALS}::BIGINT, true, 1::BIGINT""",
)
def two_stage_tuning(spark, folder):
    """All families on the middle horizon, then the best one on every horizon."""
    stages = models.tune_two_stage(supervised(spark, folder), FEATURES, TARGETS, first=FIRST_TRIALS, second=TRIALS)
    out = []
    for name, trials in zip(("first", "second"), stages, strict=True):
        families = trials.groupBy("horizon").agg(F.count_distinct("model").alias("families"))
        out.append(_searched(trials).join(families, "horizon").select(F.lit(name).alias("stage"), "*"))
    return out[0].unionByName(out[1])


# Closed form of least squares on two features, for every horizon.
PAIR = ("temp_lag1", "humidity")
LINEAR = {h: models.ModelConfig("Linear", {}) for h in DAILY_HORIZONS}
LINEAR_SQL = f"""WITH {DAILY_SQL}, {placed_sql('d')}, f AS (SELECT *, lag(temp, 1) OVER w AS x1, humidity AS x2, lag(temp, 7) OVER w AS temp_lag7
  FROM splits WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
l AS (SELECT f.series_id, f.ts, f.split, f.x1, f.x2, horizon, lead(f.temp, horizon) OVER (PARTITION BY series_id, split, horizon ORDER BY ts) AS y,
  temp_lag7 FROM f, (SELECT unnest(range(1, 6))::INT AS horizon)),
rows_ AS (SELECT * FROM l WHERE temp_lag7 IS NOT NULL),
m AS (SELECT horizon, count(*) AS n_samples, var_pop(x1) AS v1, var_pop(x2) AS v2, covar_pop(x1, x2) AS c12, covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2,
  avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM rows_ WHERE split IN ('train', 'dev') AND y IS NOT NULL GROUP BY 1),
s AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS w1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS w2 FROM m),
model AS (SELECT horizon, n_samples, w1, w2, my - w1 * m1 - w2 * m2 AS w0 FROM s),
scored AS (SELECT series_id, ts, split, horizon, y, w0 + w1 * x1 + w2 * x2 AS yhat FROM rows_ JOIN model USING (horizon))"""


def _linear_model(rows):
    return models.train_horizons(rows, PAIR, TARGETS, LINEAR)


@query(
    "ml06_linear_horizons",
    f"""{LINEAR_SQL} SELECT horizon, 'Linear' AS model, 2 AS n_features, n_samples, {r('w0')} AS intercept, {r('w1')} AS weight_temp_lag1,
  {r('w2')} AS weight_humidity FROM model""",
)
def linear_horizons(spark, folder):
    """Weights of all horizons from one pass over the rows."""
    model, metadata = _linear_model(supervised(spark, folder))
    fitted = [(h, m.getOrDefault("intercept"), *m.getOrDefault("weights")) for h, m in model.models.items()]
    weights = spark.createDataFrame(fitted, "horizon int, intercept double, weight_temp_lag1 double, weight_humidity double")
    named = metadata.select("horizon", "model", "n_features", "n_samples").join(weights, "horizon")
    return named.select("horizon", "model", "n_features", "n_samples", *[rounded(c) for c in weights.columns[1:]])


@query(
    "ml07_linear_latest",
    f"""{LINEAR_SQL}, n AS (SELECT series_id, max(ts) AS ts FROM rows_ GROUP BY 1)
SELECT series_id, ts AS base_ts, horizon, 't+' || horizon AS target, ts + to_days(horizon) AS forecast_ts, {r('yhat')} AS yhat
FROM scored JOIN n USING (series_id, ts)""",
)
def linear_latest(spark, folder):
    rows = supervised(spark, folder)
    return models.predict_latest(_linear_model(rows)[0], rows, ["series_id"], "ts", "DAY").withColumn("yhat", rnd("yhat"))


@query("ud02_linear_forecasts", f"{LINEAR_SQL} SELECT series_id, ts, horizon, {r('y')} AS y, {r('yhat')} AS yhat FROM scored WHERE split = 'test'")
def linear_forecasts(spark, folder):
    """Every test row scored for every horizon."""
    rows = supervised(spark, folder)
    scored = models.score_split(_linear_model(rows)[0], rows, "test", TARGETS, ["series_id", "ts"])
    return scored.select("series_id", "ts", "horizon", rounded("y"), rounded("yhat"))


@query(
    "ml08_linear_evaluation",
    f"""{LINEAR_SQL} SELECT horizon, {r('avg(abs(y - yhat))')} AS mae, {r('sqrt(avg(power(y - yhat, 2)))')} AS rmse,
  {r('1 - sum(power(y - yhat, 2)) / (count(*) * var_pop(y))')} AS r2, count(*) AS n_samples FROM scored WHERE split = 'test' AND y IS NOT NULL GROUP BY 1""",
)
def linear_evaluation(spark, folder):
    rows = supervised(spark, folder)
    scored = models.score_split(_linear_model(rows)[0], rows, "test", TARGETS, ["series_id", "ts"])
    return forecast_metrics(scored).select("horizon", *[rounded(c) for c in ("mae", "rmse", "r2")], "n_samples")


@query("ml06_train_horizons")
def train_horizons(spark, folder):
    _, metadata = models.train_horizons(supervised(spark, folder), FEATURES, TARGETS, DEFAULTS)
    return metadata


@query("ml07_predict_latest")
def predict_latest(spark, folder):
    rows = supervised(spark, folder)
    model, _ = models.train_horizons(rows, FEATURES, TARGETS, DEFAULTS)
    return models.predict_latest(model, rows, ["series_id"], "ts", "DAY")


@query("ud02_multi_horizon_model")
def multi_horizon_model(spark, folder):
    """Every test row scored for every horizon."""
    rows = supervised(spark, folder)
    model, _ = models.train_horizons(rows, FEATURES, TARGETS, DEFAULTS)
    return models.score_split(model, rows, "test", TARGETS, ["series_id", "ts"])


@query("ml08_model_evaluation")
def model_evaluation(spark, folder):
    rows = supervised(spark, folder)
    model, _ = models.train_horizons(rows, FEATURES, TARGETS, DEFAULTS)
    return forecast_metrics(models.score_split(model, rows, "test", TARGETS, ["series_id", "ts"]))


@query(
    "ml08_persistence_evaluation",
    f"""WITH {HOURLY_SQL}, {placed_sql('h')}, {pairs_sql(HOURLY_HORIZONS)}, {METRICS_SQL}
SELECT horizon::VARCHAR AS horizon, {rr('mae rmse mape r2')} FROM metrics
UNION ALL SELECT 'average', {', '.join(r(f'avg({c})') for c in ('mae', 'rmse', 'mape', 'r2'))} FROM metrics""",
)
def persistence_evaluation(spark, folder):
    """The yardstick: the newest value as forecast, per horizon and on average."""
    pairs = hourly_pairs(spark, folder).where("split = 'test'")
    per_horizon = settled(forecast_metrics(pairs), "metrics")
    names = ("mae", "rmse", "mape", "r2")
    rows = per_horizon.select(F.col("horizon").cast("string").alias("horizon"), *[rounded(c) for c in names])
    return rows.unionByName(average_metrics(per_horizon).select(F.lit("average").alias("horizon"), *[rounded(c) for c in names]))


@query(
    "ml11_model_inventory",
    f"""{TRIALS_SQL}, best AS (SELECT 'hourly' AS kind, horizon, model, params, rmse AS tuned_rmse FROM trials
  QUALIFY row_number() OVER (PARTITION BY horizon ORDER BY rmse, model, params) = 1),
training AS (SELECT 'hourly' AS kind, horizon, count(y) AS n_samples FROM labels WHERE split IN ('train', 'dev') GROUP BY 2),
m AS (SELECT 'hourly' AS kind, horizon, avg(abs(y - temp)) AS mae, sqrt(avg((y - temp) * (y - temp))) AS rmse FROM labels
  WHERE split = 'test' AND y IS NOT NULL GROUP BY 2)
SELECT t.kind, t.horizon, b.model, b.params, {r('b.tuned_rmse')} AS tuned_rmse, t.n_samples, round_even(m.mae, 3) + 0.0 AS mae, round_even(m.rmse, 3) + 0.0 AS rmse
FROM training t LEFT JOIN best b USING (kind, horizon) LEFT JOIN m USING (kind, horizon)""",
)
def model_inventory(spark, folder):
    """Tuning, training and metric tables on one row per horizon."""
    kind = F.lit("hourly").alias("kind")
    trials, training, tested = naive_summary(spark, folder)
    out = registry.inventory(
        winners(trials.where("n_samples > 0")).select(kind, "horizon", "model", "params", rnd("rmse", 6).alias("tuned_rmse")),
        training.where("n_samples > 0").select(kind, "horizon", "n_samples"),
        tested.where("n_samples > 0").select(kind, "horizon", "mae", "rmse", "mape", "r2"),
        "hourly",
    )
    return out.select("kind", "horizon", "model", "params", "tuned_rmse", "n_samples", "mae", "rmse")


@query(
    "ml12_promoted_models",
    f"""{TRIALS_SQL}, v AS (SELECT model || ' ' || params || ' ' || horizon AS model_id, horizon, trial AS version, rmse, avg(rmse) OVER (PARTITION BY horizon) AS m FROM trials)
SELECT model_id, horizon, version, 'production' AS stage FROM v WHERE rmse <= m
QUALIFY row_number() OVER (PARTITION BY horizon ORDER BY version DESC) = 1""",
)
def promoted_models(spark, folder):
    """Models no worse than the mean of their horizon are promoted; the newest of each horizon is listed."""
    trials = settled(naive_trials(spark, folder), "trials")
    table_ = trials.select(
        F.lit("hourly").alias("kind"), F.concat_ws(" ", "model", "params", F.col("horizon").cast("string")).alias("model_id"),
        "horizon", F.col("trial").alias("version"), F.lit("staging").alias("stage"), "rmse",
    )
    means = table_.groupBy("horizon").agg(F.avg("rmse").alias("m"))
    chosen = table_.join(means, "horizon").where("rmse <= m").select("model_id")
    return registry.production_models(registry.promote(table_, chosen)).select("model_id", "horizon", "version", "stage")


@query(
    "ml13_evaluation_points",
    f"""WITH {DAILY_SQL}, {placed_sql('d')}, {pairs_sql(DAILY_HORIZONS)}
SELECT series_id, horizon, ts, {r('y')} AS y, {r('yhat')} AS yhat, {r('abs(y - yhat)')} AS error FROM pairs
WHERE split = 'test' AND y IS NOT NULL""",
)
def evaluation_points(spark, folder):
    """All actual / predicted pairs of each series and horizon."""
    pairs = daily_pairs(spark, folder).where("split = 'test' AND y IS NOT NULL")
    return pairs.select(
        "series_id", "horizon", "ts", rounded("y"), rounded("yhat"), rnd(F.abs(F.col("y") - F.col("yhat")), 6).alias("error")
    )
