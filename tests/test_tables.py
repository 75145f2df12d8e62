"""Filters, duplicates, ranks, metrics, correlation."""

from datetime import timedelta

import numpy as np
import pytest
from frames import START, hours, ordered
from pyspark.sql import functions as F

from loomcast.operators import correlate, dedup, filters, metrics, ranking, topk


def test_average_rank_with_tie_and_missing(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 3.0), ("d", None)], "feature string, s double")
    got = {r["feature"]: r["s_rank"] for r in ranking.add_mean_rank(df, ["s"]).collect()}
    assert got == {"a": 1.5, "b": 3.0, "c": 1.5, "d": 1e6}


def test_lists_and_overlap(spark):
    short = spark.createDataFrame([("a",), ("b",)], "feature string")
    long = spark.createDataFrame([("b",), ("c",), ("d",)], "feature string")
    assert {r["part"]: r["features"] for r in ranking.overlap(short, long).collect()} == {
        "combined": 4, "shared": 1, "short_only": 1, "long_only": 2,
    }
    rows = ranking.assign_lists(short, long, (1, 2, 3)).groupBy("horizon", "feature_type").count().collect()
    assert {(r["horizon"], r["feature_type"], r["count"]) for r in rows} == {(1, "SHORT-TERM", 2), (2, "COMBINED", 4), (3, "LONG-TERM", 3)}
    assert ranking.same_features(short, short.unionAll(short)) and not ranking.same_features(short, long)


def test_top_features_break_ties_by_name(spark):
    df = spark.createDataFrame([("z", 1.0), ("y", 1.0), ("x", 2.0)], "feature string, mean_rank double")
    assert [r["feature"] for r in ranking.top_features(df, 2).orderBy("place").collect()] == ["y", "z"]


def test_metrics_of_three_pairs(spark):
    df = spark.createDataFrame([(1, 1.0, 1.1), (1, 2.0, 1.8), (1, 4.0, 4.3), (1, None, 1.0)], "horizon int, y double, yhat double")
    row = metrics.forecast_metrics(df).first()
    assert row["mae"] == pytest.approx(0.2) and row["rmse"] == pytest.approx((0.14 / 3) ** 0.5)
    assert row["r2"] == pytest.approx(0.97) and row["n_samples"] == 3


def test_zero_actual_has_no_percentage(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0), (1, 2.0, 1.0)], "horizon int, y double, yhat double")
    assert metrics.forecast_metrics(df).first()["mape"] == pytest.approx(50.0)


def test_winners_and_shares(spark):
    trials = spark.createDataFrame(
        [(1, "A", "p", 2.0, 1.0), (1, "B", "q", 1.0, 1.0), (2, "A", "p", 0.5, 1.0), (3, "A", "z", 1.0, 1.0)],
        "horizon int, model string, params string, rmse double, mae double",
    )
    best = metrics.winners(trials)
    assert {(r["horizon"], r["model"]) for r in best.collect()} == {(1, "B"), (2, "A"), (3, "A")}
    shares = {r["model"]: r["percent"] for r in metrics.model_shares(best).collect()}
    assert shares["A"] == pytest.approx(200 / 3)


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, "c"), (2, 1, "d")], "k int, o int, v string")
    assert {r["v"] for r in dedup.keep_first(df, ["k"], ["o"]).collect()} == {"a", "d"}
    assert {r["v"] for r in dedup.keep_last(df, ["k"], ["o"]).collect()} == {"c", "d"}


def test_forecast_wins_over_history(spark):
    history = hours(spark, [1.0, 2.0]).withColumn("is_forecast", F.lit(False)).withColumn("precip", F.lit(3.0))
    forecast = hours(spark, [9.0, 8.0], start=START + timedelta(hours=1)).withColumn("is_forecast", F.lit(True))
    out = dedup.merge_history_and_forecast(history, forecast, ["series_id", "ts"])
    assert ordered(out, "temp", "precip", "is_forecast") == [(1.0, 3.0, False), (9.0, None, True), (8.0, None, True)]


def test_only_new_rows(spark):
    incoming, stored = hours(spark, [1.0, 2.0, 3.0]), hours(spark, [1.0, 2.0])
    assert ordered(dedup.only_new(incoming, stored, ["series_id", "ts"]), "temp") == [(3.0,)]


def test_clamped_requests():
    assert topk.clamp_rows(None, 365) is None
    assert [topk.clamp_rows(n, 365) for n in (-3, 0, 10, 9999)] == [1, 1, 10, 365]


def test_history_filter_reaches_the_scan(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    plan = filters.history_filter(events, "ts", "2024-01-05", "2024-01-06", year=2024)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_history_filter_bounds_are_inclusive_days(spark):
    df = hours(spark, [float(i) for i in range(24 * 40)])
    kept = filters.history_filter(df, "ts", "2024-01-30", "2024-02-02", "February", 2024)
    assert kept.agg(F.min("ts"), F.max("ts"), F.count("*")).first()[:] == (START + timedelta(days=31), START + timedelta(days=32, hours=23), 48)


def test_lookup_prefers_the_exact_time(spark):
    at = [START, START + timedelta(seconds=20), START + timedelta(minutes=3, seconds=5)]
    stored = spark.createDataFrame([(t, float(i)) for i, t in enumerate(at)], "ts timestamp_ntz, v double")
    asked = [START + timedelta(seconds=20), START + timedelta(seconds=40), START + timedelta(minutes=3), START + timedelta(minutes=9)]
    out = filters.lookup_time(spark.createDataFrame([(t,) for t in asked], "ts timestamp_ntz"), stored, [], "ts", "v")
    assert ordered(out, "found_v", "exact") == [(1.0, True), (0.0, False), (2.0, False), (None, False)]


def test_first_and_last_of_date_without_key(spark):
    df = hours(spark, [float(i) for i in range(48)]).drop("series_id")
    assert filters.first_of_date(df, [], "ts", "2024-01-02").first()["temp"] == 24.0
    assert filters.first_of_date(df, [], "ts", "2024-01-02", last=True).first()["temp"] == 47.0
    assert filters.first_of_date(df, [], "ts", "2025-01-02").count() == 0


def test_empty_columns_follow_the_training_rows(spark):
    df = spark.createDataFrame([("train", 1.0, None), ("test", None, 2.0)], "split string, a double, b double")
    assert filters.drop_empty_columns(df, ["a", "b"], F.col("split") == "train").columns == ["split", "a"]
    got = {r["column_name"]: (r["nulls"], r["all_null"]) for r in filters.null_counts(df, ["a", "b"]).collect()}
    assert got == {"a": (1, False), "b": (1, False)}


def test_columns_of_kind(spark):
    df = spark.createDataFrame([(1, "x", 1.0)], "i int, s string, d double")
    assert filters.columns_of_kind(df, True) == ["i", "d"] and filters.columns_of_kind(df, False) == ["s"]


def test_correlation_vif_and_information(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=400)
    b, c = a + rng.normal(size=400) * 0.5, rng.normal(size=400)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(a, b, c)], "a double, b double, c double")
    table = np.corrcoef([a, b, c])
    got = {(r["a"], r["b"]): r["correlation"] for r in correlate.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == pytest.approx(table[0, 1]) and got[("b", "a")] == got[("a", "b")] and len(got) == 9
    vif = {r["feature"]: r["vif"] for r in correlate.variance_inflation(df, ["a", "b", "c"]).collect()}
    assert vif["a"] == pytest.approx(np.linalg.inv(table)[0, 0])
    mi = {r["feature"]: r["mutual_info"] for r in correlate.mutual_information(df, ["b", "c"], "a", 8).collect()}
    assert mi["b"] > mi["c"] >= 0


def test_information_of_a_constant_is_zero(spark):
    df = spark.range(50).select(F.lit(1.0).alias("k"), F.col("id").cast("double").alias("y"))
    assert correlate.mutual_information(df, ["k"], "y").first()["mutual_info"] == pytest.approx(0)


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, float(i), float(2 * i), float(i % 3)) for i in range(9)], "k double, y double, x double, m double")
    got = {r["feature"]: r["correlation"] for r in correlate.correlation_with(df, ["k", "x"], "y").collect()}
    assert got["k"] is None and got["x"] == pytest.approx(1)
    vif = {r["feature"]: r["vif"] for r in correlate.variance_inflation(df, ["k", "x", "y", "m"]).collect()}
    assert vif["k"] is None and vif["x"] == float("inf") and 1 <= vif["m"] < 2


def test_correlation_skips_rows_without_both(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (3.0, 5.0), (None, 100.0), (50.0, None)], "a double, b double")
    got = df.agg(correlate.correlation("a", "b")).first()[0]
    assert got == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.5, 5])[0, 1])
