"""Queries over aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.operators import correlate, filters, metrics, quantiles
from loomcast.plans.catalog import query, r, rnd, rounded, rr
from loomcast.plans.panels import (
    DAILY_HORIZONS, DAILY_SQL, HOURLY_SQL, METRICS_SQL,
    daily_pairs, daily_panel, daily_splits, hourly_panel, pairs_sql, placed_sql,
)
from loomcast.plans.q_rows import FORECAST_SQL, history_and_forecast
from loomcast.plans.q_scores import TRIALS_SQL, naive_trials
from loomcast.session import settled
from loomcast.sources.readers import table

QUANTITIES = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    "ag01_table_health",
    "SELECT event_type AS series_id, count(*) AS records, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1",
)
def table_health(spark, folder):
    return table(spark, folder, "events").groupBy(F.col("event_type").alias("series_id")).agg(
        F.count(F.lit(1)).alias("records"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


def _quantile_sql(column: str, p: str) -> str:
    return f"SELECT '{column}' AS feature, {p}::DOUBLE AS p, count({column}) AS n, {r(f'quantile_cont({column}, {p})')} AS value FROM lineitem"


@query("ag02_exact_quantiles", " UNION ALL ".join(_quantile_sql(c, p) for c in QUANTITIES for p in ("0.25", "0.75")))
def exact_quantiles(spark, folder):
    out = quantiles.exact_quantiles(table(spark, folder, "lineitem"), QUANTITIES, (0.25, 0.75))
    return out.select("feature", "p", "n", rounded("value"))


def _fence_sql(column: str) -> str:
    return f"""SELECT l_returnflag, '{column}' AS feature, {r('q1')} AS q1, {r('q3')} AS q3,
  {r('q1 - 1.5 * (q3 - q1)')} AS lower, {r('q3 + 1.5 * (q3 - q1)')} AS upper
FROM (SELECT l_returnflag, quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM lineitem GROUP BY 1)"""


@query("ag03_iqr_fences", " UNION ALL ".join(_fence_sql(c) for c in QUANTITIES))
def iqr_fences(spark, folder):
    out = quantiles.iqr_fences(table(spark, folder, "lineitem"), QUANTITIES, by=["l_returnflag"])
    return out.select("l_returnflag", "feature", *[rounded(c) for c in ("q1", "q3", "lower", "upper")])


@query(
    "ag04_centres",
    f"""WITH {DAILY_SQL}, {placed_sql('d')}, t AS (SELECT * FROM splits WHERE split = 'train'),
modes AS (SELECT icon FROM t WHERE icon IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, icon LIMIT 1)
SELECT 'humidity' AS feature, {r('median(humidity)')} AS median_value, {r('avg(humidity)')} AS mean_value, (SELECT icon FROM modes) AS icon FROM t
UNION ALL SELECT 'precip', {r('median(precip)')}, {r('avg(precip)')}, (SELECT icon FROM modes) FROM t""",
)
def centres(spark, folder):
    """Median, mean and most frequent value of the training rows."""
    train = settled(daily_splits(spark, folder, "humidity", "precip", "icon").where("split = 'train'").select("humidity", "precip", "icon"), "centres")
    medians = quantiles.quantiles_wide(train, ["humidity", "precip"], (0.5,)).select("feature", rnd("q0", 6).alias("median_value"))
    means = train.agg(F.avg("humidity").alias("humidity"), F.avg("precip").alias("precip")).unpivot(
        [], ["humidity", "precip"], "feature", "mean_value"
    )
    icon = quantiles.most_frequent(train, "icon").first()
    return medians.join(means, "feature").select("feature", "median_value", rounded("mean_value"), F.lit(icon["icon"] if icon else None).alias("icon"))


@query(
    "ag05_moments",
    f"""WITH {DAILY_SQL}, {placed_sql('d')}, t AS (SELECT *, 1.0::DOUBLE AS fixed FROM splits WHERE split = 'train')
SELECT 'humidity' AS feature, {r('avg(humidity)')} AS mean, {r('stddev_pop(humidity)')} AS std FROM t
UNION ALL SELECT 'fixed', {r('avg(fixed)')}, CASE WHEN stddev_pop(fixed) = 0 THEN 1.0 ELSE stddev_pop(fixed) END FROM t""",
)
def moments(spark, folder):
    """Mean and population deviation; a column without spread gets 1."""
    train = daily_splits(spark, folder, "humidity").where("split = 'train'").select("humidity", F.lit(1.0).alias("fixed"))
    wide = train.agg(*[f(c).alias(f"{c}_{n}") for c in ("humidity", "fixed") for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            rnd(f"{c}_m", 6).alias("mean"),
            rnd(F.when(F.col(f"{c}_s") == 0, 1.0).otherwise(F.col(f"{c}_s")), 6).alias("std"),
        )
        for c in ("humidity", "fixed")
    ]
    return wide.select(F.inline(F.array(*rows)))


CORRELATED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


@query(
    "ag06_correlation",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, {r(f'abs(corr({c}, l_extendedprice))')} AS correlation FROM lineitem" for c in CORRELATED if c != "l_extendedprice"),
)
def correlation(spark, folder):
    features = [c for c in CORRELATED if c != "l_extendedprice"]
    out = correlate.correlation_with(table(spark, folder, "lineitem"), features, "l_extendedprice")
    return out.select("feature", rnd(F.abs("correlation"), 6).alias("correlation"))


@query(
    "ag07_correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {'1.0::DOUBLE' if a == b else r(f'corr({a}, {b})')} AS correlation, "
        f"{'TRUE' if a == b else f'corr({a}, {b}) > 0'} AS positive FROM lineitem GROUP BY ()"
        for a in CORRELATED for b in CORRELATED
    ),
)
def correlation_matrix(spark, folder):
    out = correlate.correlation_matrix(table(spark, folder, "lineitem"), CORRELATED)
    return out.select("a", "b", rounded("correlation"), (F.col("correlation") > 0).alias("positive"))


@query(
    "ag08_variance_inflation",
    f"""WITH c AS (SELECT corr(l_quantity, l_discount) AS ab, corr(l_quantity, l_extendedprice) AS ac, corr(l_discount, l_extendedprice) AS bc FROM lineitem),
dets AS (SELECT *, 1 + 2 * ab * ac * bc - ab * ab - ac * ac - bc * bc AS det FROM c)
SELECT 'l_quantity' AS feature, {r('(1 - bc * bc) / det')} AS vif FROM dets
UNION ALL SELECT 'l_discount', {r('(1 - ac * ac) / det')} FROM dets
UNION ALL SELECT 'l_extendedprice', {r('(1 - ab * ab) / det')} FROM dets""",
)
def variance_inflation(spark, folder):
    out = correlate.variance_inflation(table(spark, folder, "lineitem"), ["l_quantity", "l_discount", "l_extendedprice"])
    return out.select("feature", rounded("vif"))


def _daily_metrics(spark, folder):
    pairs = daily_pairs(spark, folder)
    return metrics.forecast_metrics(pairs.where("split = 'test'"))


DAILY_METRICS_SQL = f"WITH {DAILY_SQL}, {placed_sql('d')}, {pairs_sql(DAILY_HORIZONS)}, {METRICS_SQL}"


@query("ag09_forecast_metrics", f"{DAILY_METRICS_SQL} SELECT horizon, {rr('mae rmse mape r2')}, n_samples FROM metrics")
def forecast_metrics(spark, folder):
    return _daily_metrics(spark, folder).select("horizon", *[rounded(c) for c in ("mae", "rmse", "mape", "r2")], "n_samples")


@query(
    "ag10_average_metrics",
    f"{DAILY_METRICS_SQL} SELECT {', '.join(r(f'avg({c})') + f' AS {c}' for c in ('mae', 'rmse', 'mape', 'r2'))}, {r('avg(r2)', 3)} AS average_confidence FROM metrics",
)
def average_metrics(spark, folder):
    out = metrics.average_metrics(_daily_metrics(spark, folder))
    return out.select(*[rounded(c) for c in ("mae", "rmse", "mape", "r2")], "average_confidence")


WINNERS_SQL = f"""{TRIALS_SQL}, best AS (SELECT horizon, model, params, rmse, mae FROM trials
  QUALIFY row_number() OVER (PARTITION BY horizon ORDER BY rmse, model, params) = 1)"""


@query("ag11_winning_model", f"{WINNERS_SQL} SELECT horizon, model, params, {r('rmse')} AS rmse, {r('mae')} AS mae FROM best")
def winning_model(spark, folder):
    return metrics.winners(naive_trials(spark, folder)).select("horizon", "model", "params", rounded("rmse"), rounded("mae"))


@query(
    "ag12_model_shares",
    f"{WINNERS_SQL} SELECT model, count(*) AS horizons, {r('count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()')} AS percent FROM best GROUP BY 1",
)
def model_shares(spark, folder):
    best = metrics.winners(naive_trials(spark, folder))
    return metrics.model_shares(best).select("model", "horizons", rounded("percent"))


@query(
    "ag13_null_counts",
    f"""WITH {DAILY_SQL} SELECT 'icon' AS column_name, count(*) - count(icon) AS nulls, count(icon) = 0 AS all_null FROM d
UNION ALL SELECT 'temp', count(*) - count(temp), count(temp) = 0 FROM d
UNION ALL SELECT 'snow', count(*), TRUE FROM d""",
)
def null_counts(spark, folder):
    panel = daily_panel(spark, folder).select("icon", "temp", F.lit(None).cast("double").alias("snow"))
    return filters.null_counts(panel, ["icon", "temp", "snow"])


@query("ag14_filter_options", "SELECT DISTINCT year(l_shipdate)::INT AS year, monthname(l_shipdate) AS month FROM lineitem")
def filter_options(spark, folder):
    items = table(spark, folder, "lineitem")
    return items.select(F.year("l_shipdate").alias("year"), F.date_format("l_shipdate", "MMMM").alias("month")).distinct()


def daily_values(panel):
    """Daily values of an hourly panel: mean, extremes, sums and the share of hours with precipitation."""
    return panel.groupBy("series_id", F.col("ts").cast("date").cast("timestamp_ntz").alias("ts")).agg(
        F.avg("temp").alias("temp"),
        F.max("temp").alias("tempmax"),
        F.min("temp").alias("tempmin"),
        F.sum("precip").alias("precip"),
        F.avg("humidity").alias("humidity"),
        F.max("windspeed").alias("windgust"),
        F.avg("windspeed").alias("windspeed"),
        (100.0 * F.avg((F.col("precip") > 3).cast("int"))).alias("precipcover"),
    )


@query(
    "ag15_daily_from_hourly",
    f"""WITH {HOURLY_SQL} SELECT series_id, date_trunc('day', ts) AS ts, {r('avg(temp)')} AS temp, {r('max(temp)')} AS tempmax,
  {r('min(temp)')} AS tempmin, sum(precip) AS precip, {r('avg(humidity)')} AS humidity, {r('max(windspeed)')} AS windgust,
  {r('avg(windspeed)')} AS windspeed, {r('100 * avg((precip > 3)::INT)')} AS precipcover FROM h GROUP BY 1, 2""",
)
def daily_from_hourly(spark, folder):
    out = daily_values(hourly_panel(spark, folder))
    return out.withColumns({c: rnd(c, 6) for c in out.columns if c not in ("series_id", "ts", "precip")})


@query(
    "ag16_mutual_information",
    f"""WITH b AS (SELECT least(floor((l_quantity - min(l_quantity) OVER ()) / (max(l_quantity) OVER () - min(l_quantity) OVER ()) * 20), 19) AS bx,
  least(floor((l_extendedprice - min(l_extendedprice) OVER ()) / (max(l_extendedprice) OVER () - min(l_extendedprice) OVER ()) * 20), 19) AS b1 FROM lineitem),
c AS (SELECT bx, b1, count(*)::DOUBLE AS n FROM b GROUP BY 1, 2),
m AS (SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY bx) AS nx, sum(n) OVER (PARTITION BY b1) AS ny FROM c)
SELECT 'l_quantity' AS feature, {r('sum(n / t * ln(n * t / (nx * ny)))')} AS mutual_info FROM m""",
)
def mutual_information(spark, folder):
    out = correlate.mutual_information(table(spark, folder, "lineitem"), ["l_quantity"], "l_extendedprice")
    return out.select("feature", rounded("mutual_info"))


@query("ag18_latest_date", f"WITH {FORECAST_SQL} SELECT series_id, coalesce(max(ts) FILTER (WHERE NOT is_forecast), max(ts)) AS latest FROM both_rows GROUP BY 1")
def latest_date(spark, folder):
    history, forecast = history_and_forecast(spark, folder)
    both = history.unionByName(forecast, allowMissingColumns=True)
    return both.groupBy("series_id").agg(
        F.coalesce(F.max(F.when(~F.col("is_forecast"), F.col("ts"))), F.max("ts")).alias("latest")
    )
