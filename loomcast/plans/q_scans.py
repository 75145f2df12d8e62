"""Queries over sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.operators.chunks import DAILY
from loomcast.operators.metrics import forecast_metrics
from loomcast.operators.split import split_targets
from loomcast.plans.catalog import query, r, rnd, rounded, rr
from loomcast.plans.panels import (
    DAILY_HORIZONS, DAILY_SQL, HOURLY_HORIZONS, HOURLY_SQL, METRICS_SQL,
    daily_pairs, daily_panel, hourly_pairs, hourly_panel, pairs_sql, placed_sql,
)
from loomcast.plans.q_scores import RANKING_SQL, TRIALS_SQL, naive_trials, panel_ranking
from loomcast.session import scratch_path
from loomcast.sources import readers, schemas, writers

TARGETS_SQL = """labelled AS (
  SELECT series_id, ts, split, horizon, precip,
    lead(temp, horizon) OVER (PARTITION BY series_id, split, horizon ORDER BY ts) AS y
  FROM splits, (SELECT unnest(range(1, 6))::INT AS horizon))"""


@query(
    "sc01_csv_scan",
    f"WITH {HOURLY_SQL} SELECT series_id, ts, {r('temp', 3)} AS temp, precip, winddir FROM h",
)
def csv_scan(spark, folder):
    """Panel written as delimited text, read back with a declared schema."""
    path = scratch_path(spark, "csv")
    panel = hourly_panel(spark, folder)
    names = [f.name for f in schemas.HOURLY_OBSERVATIONS.fields]
    given = {"name": F.col("series_id"), "datetime": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "temp": rnd("temp", 3), "precip": F.col("precip"), "winddir": F.col("winddir")}
    panel.select(*[given.get(n, F.lit(None).cast("string")).alias(n) for n in names]).write.option("header", True).csv(path)
    read = readers.read_observations(spark, path, schemas.HOURLY_OBSERVATIONS)
    return read.select("series_id", "ts", "temp", "precip", "winddir")


@query(
    "sc02_range_scan",
    "SELECT event_id, ts, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'",
)
def range_scan(spark, folder):
    events = readers.table(spark, folder, "events")
    return readers.time_range(events, "ts", "2024-01-10", "2024-01-20").select("event_id", "ts", "event_type", "value")


CONTRACT = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "sc03_feature_contract",
    " UNION ALL ".join(f"SELECT {i} AS place, '{c}' AS feature, count({c}) AS filled FROM lineitem" for i, c in enumerate(CONTRACT)),
)
def feature_contract(spark, folder):
    """Feature order from the schema alone; then one aggregate over the table for its filled values."""
    items = readers.table(spark, folder, "lineitem")
    outside = [f.name for f in items.schema.fields if f.dataType.typeName() in ("string", "timestamp_ntz")]
    names = readers.feature_contract(items, outside)
    counts = items.agg(*[F.count(c).alias(c) for c in names])
    rows = [F.struct(F.lit(i).alias("place"), F.lit(c).alias("feature"), F.col(c).alias("filled")) for i, c in enumerate(names)]
    return counts.select(F.inline(F.array(*rows)))


@query(
    "sc04_split_horizon_scan",
    f"WITH {DAILY_SQL}, {placed_sql('d')}, {TARGETS_SQL} "
    f"SELECT series_id, ts, precip, {r('y')} AS y FROM labelled WHERE split = 'train' AND horizon = 3 AND y IS NOT NULL",
)
def split_horizon_scan(spark, folder):
    """Only one partition folder of the split table is read."""
    path = scratch_path(spark, "splits")
    writers.write_split_tables(_long_targets(spark, folder), path, ("split", "horizon"))
    rows = readers.read_split(spark, path, "train", 3)
    return rows.select("series_id", "ts", "precip", rounded("y"))


def _long_targets(spark, folder):
    wide = split_targets(daily_panel(spark, folder).select("series_id", "ts", "temp", "precip"), DAILY, "temp", DAILY_HORIZONS)
    pairs = [F.struct(F.lit(h).alias("horizon"), F.col(f"`target_temp_t+{h}`").alias("y")) for h in DAILY_HORIZONS]
    return wide.select("series_id", "ts", "split", "precip", F.inline(F.array(*pairs))).where("y IS NOT NULL")


def _hourly_metrics(spark, folder):
    pairs = hourly_pairs(spark, folder)
    return forecast_metrics(pairs.where("split = 'test'"))


@query(
    "sc05_nested_json_scan",
    f"WITH {HOURLY_SQL}, {placed_sql('h')}, {pairs_sql(HOURLY_HORIZONS)}, {METRICS_SQL} "
    f"SELECT 't+' || horizon || 'h' AS target, horizon AS hour, {r('mae')} AS mae, {r('rmse')} AS rmse, "
    f"{r('mape')} AS mape, {r('r2')} AS r2 FROM metrics",
)
def nested_json_scan(spark, folder):
    """Metrics written as a map keyed by horizon, exploded when read."""
    base = scratch_path(spark, "metrics")
    writers.write_metrics(_hourly_metrics(spark, folder), f"{base}/json", f"{base}/table")
    rows = readers.read_metrics_json(spark, f"{base}/json")
    return rows.select("target", "hour", *[rnd(c, 6).alias(c.lower()) for c in ("MAE", "RMSE", "MAPE", "R2")])


@query(
    "sc06_metrics_csv_scan",
    f"WITH {DAILY_SQL}, {placed_sql('d')}, {pairs_sql(DAILY_HORIZONS)}, {METRICS_SQL} "
    f"SELECT 't+' || horizon AS target, {rr('mae rmse mape r2')}, n_samples::INT AS n_samples FROM metrics",
)
def metrics_csv_scan(spark, folder):
    path = scratch_path(spark, "metrics-csv")
    pairs = daily_pairs(spark, folder)
    writers.write_metrics_csv(forecast_metrics(pairs.where("split = 'test'")), path)
    rows = readers.read_metrics_csv(spark, path)
    return rows.select("target", *[rnd(c, 6).alias(c.lower()) for c in ("MAE", "RMSE", "MAPE", "R2")], "n_samples")


@query(
    "sk01_split_tables",
    f"WITH {DAILY_SQL}, {placed_sql('d')}, {TARGETS_SQL} "
    f"SELECT split, horizon, count(*) AS n, {r('sum(y)', 4)} AS total FROM labelled WHERE y IS NOT NULL GROUP BY 1, 2",
)
def split_tables(spark, folder):
    path = scratch_path(spark, "split-tables")
    writers.write_split_tables(_long_targets(spark, folder), path, ("split", "horizon"))
    rows = spark.read.parquet(path)
    return rows.groupBy("split", "horizon").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("y"), 4).alias("total"))


@query("sk02_rank_tables", f"{RANKING_SQL} SELECT feature, place, {r('mean_rank')} AS mean_rank FROM placed_rank WHERE place <= 4")
def rank_tables(spark, folder):
    path = scratch_path(spark, "ranking")
    writers.write_table(panel_ranking(spark, folder), path)
    return spark.read.parquet(path).where("place <= 4").select("feature", "place", rounded("mean_rank"))


@query(
    "sk03_metric_tables",
    f"WITH {HOURLY_SQL}, {placed_sql('h')}, {pairs_sql(HOURLY_HORIZONS)}, {METRICS_SQL} "
    f"SELECT horizon, {rr('mae rmse mape r2')}, n_samples FROM metrics",
)
def metric_tables(spark, folder):
    base = scratch_path(spark, "metrics")
    writers.write_metrics(_hourly_metrics(spark, folder), f"{base}/json", f"{base}/table")
    rows = spark.read.parquet(f"{base}/table")
    return rows.select("horizon", *[rounded(c) for c in ("mae", "rmse", "mape", "r2")], "n_samples")


@query(
    "sk04_training_log",
    f"WITH {DAILY_SQL}, {placed_sql('d')}, {TARGETS_SQL} "
    "SELECT horizon, 'train' AS part, count(*) AS n_samples FROM labelled WHERE y IS NOT NULL AND split = 'train' GROUP BY 1 "
    "UNION ALL SELECT horizon, 'train+dev', count(*) FROM labelled WHERE y IS NOT NULL AND split IN ('train', 'dev') GROUP BY 1",
)
def training_log(spark, folder):
    """Two runs append their metadata rows to one log table."""
    path = scratch_path(spark, "training-log")
    rows = _long_targets(spark, folder)
    for part, splits in (("train", ("train",)), ("train+dev", ("train", "dev"))):
        counted = rows.where(F.col("split").isin(*splits)).groupBy("horizon").agg(F.count(F.lit(1)).alias("n_samples"))
        writers.append_rows(counted.withColumn("part", F.lit(part)), path)
    return spark.read.parquet(path).select("horizon", "part", "n_samples")


@query(
    "sk05_export_records",
    f"""WITH {HOURLY_SQL}, clean AS (
  SELECT series_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, precip,
    CASE WHEN precip > 1 THEN humidity END AS ratio FROM h)
SELECT series_id, ts, to_json({{'series_id': series_id, 'ts': ts, 'precip': precip, 'ratio': ratio}})::VARCHAR AS record FROM clean""",
)
def export_records(spark, folder):
    """Non-finite values become null in the records."""
    panel = hourly_panel(spark, folder)
    ratio = F.when(F.col("precip") > 1, F.col("humidity")).otherwise(F.lit(float("nan")))
    return writers.export_records(panel.select("series_id", "ts", "precip", ratio.alias("ratio")), ["series_id"], "ts")


@query(
    "sk05_export_envelope",
    f"""WITH {HOURLY_SQL} SELECT series_id, count(*) AS total_records,
  strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS start, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS "end" FROM h GROUP BY 1""",
)
def export_envelope(spark, folder):
    return writers.export_envelope(hourly_panel(spark, folder), ["series_id"], "ts")


@query(
    "sk06_trial_log",
    f"{TRIALS_SQL} SELECT model, count(*) AS trials, {r('min(rmse)')} AS best_rmse, {r('min(mae)')} AS best_mae FROM trials GROUP BY 1",
)
def trial_log(spark, folder):
    path = scratch_path(spark, "trials")
    writers.append_rows(naive_trials(spark, folder), path)
    rows = spark.read.parquet(path)
    return rows.groupBy("model").agg(
        F.count(F.lit(1)).alias("trials"), rnd(F.min("rmse"), 6).alias("best_rmse"), rnd(F.min("mae"), 6).alias("best_mae")
    )
