import random
from datetime import timedelta

import pytest
from frames import START, hours, ordered
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomcast.operators.chunks import HOURLY, SeriesShape, over_chunks, with_positions
from loomcast.operators.decompose import decompose
from loomcast.operators.grid import densify
from loomcast.operators.split import chronological_split, hashed_split
from loomcast.operators.windows import add_lags, add_targets, add_trailing, centred_mean, trailing


def test_lag_mean_lead_of_five_rows(spark):
    df = hours(spark, [1.0, 2.0, 3.0, 4.0, 5.0])
    lagged = add_lags(df, HOURLY, {"temp": (1,), "absent": (2,)}, "h")
    assert [r[0] for r in ordered(lagged, "temp_lag1h")] == [None, 1, 2, 3, 4]
    rolled = add_trailing(df, HOURLY, ["temp"], "mean", (2,))
    assert [r[0] for r in ordered(rolled, "temp_roll_mean_2")] == [None, None, 1.5, 2.5, 3.5]
    led = add_targets(df, HOURLY, "temp", (1,), "h")
    assert [r[0] for r in ordered(led, "`target_temp_t+1h`")] == [2, 3, 4, 5, None]


def test_trailing_statistics_need_a_full_frame(spark):
    df = hours(spark, [1.0, None, 3.0, 4.0, 6.0])
    out = add_trailing(df, HOURLY, ["temp"], "max", (2,))
    assert [r[0] for r in ordered(out, "temp_roll_max_2")] == [None, None, None, None, 4.0]
    std = add_trailing(df, HOURLY, ["temp"], "std", (2,))
    assert [r[0] for r in ordered(std, "temp_roll_std_2")][4] == pytest.approx(0.5**0.5)


def test_series_do_not_leak_into_each_other(spark):
    a, b = hours(spark, [1.0, 2.0, 3.0], "a"), hours(spark, [10.0, 20.0, 30.0], "b")
    rows = a.unionAll(b).collect()
    random.Random(3).shuffle(rows)
    mixed = spark.createDataFrame(rows, a.schema)
    out = add_lags(mixed, HOURLY.with_chunk(2), {"temp": (1,)})
    got = {(r["series_id"], r["temp"]): r["temp_lag1"] for r in out.collect()}
    assert got == {("a", 1): None, ("a", 2): 1, ("a", 3): 2, ("b", 10): None, ("b", 20): 10, ("b", 30): 20}


def test_missing_series_key_is_kept(spark):
    df = hours(spark, [1.0, 2.0, 3.0], None)
    out = add_lags(df, HOURLY.with_chunk(2), {"temp": (1,)})
    assert [r[0] for r in ordered(out, "temp_lag1")] == [None, 1, 2]


def irregular(spark, seed, n):
    """One series with gaps of very different lengths, shuffled."""
    rng, ts, rows = random.Random(seed), START, []
    for i in range(n):
        ts += timedelta(hours=rng.choice([1, 1, 1, 2, 5, 300]))
        rows.append(("a" if seed % 2 else "b", ts, float(rng.randint(0, 50))))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, temp double")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 1000), n=st.integers(1, 120), chunk=st.integers(1, 40))
def test_chunked_windows_equal_whole_windows(spark, seed, n, chunk):
    df = irregular(spark, seed, n)

    def build(w):
        return [
            F.lag("temp", 7).over(w).alias("lag7"),
            F.lead("temp", 3).over(w).alias("lead3"),
            trailing(w, "temp", "mean", 5).alias("mean5"),
            centred_mean(w, "temp", 7).alias("c7"),
            centred_mean(w, "temp", 4).alias("c4"),
        ]

    names = ("ts", "lag7", "lead3", "mean5", "c7", "c4")
    whole = ordered(df.select("*", *build(Window.partitionBy("series_id").orderBy("ts"))), *names)
    chunked = ordered(over_chunks(df, HOURLY.with_chunk(chunk), build, back=7, ahead=3), *names)
    assert len(whole) == len(chunked)
    for left, right in zip(whole, chunked):
        assert left[0] == right[0]
        assert left[1:] == pytest.approx(right[1:]) if None not in left[1:] else all(
            x == y or (x is not None and y == pytest.approx(x)) for x, y in zip(left[1:], right[1:])
        )


def test_positions_of_one_series_without_key(spark):
    df = hours(spark, [float(i) for i in range(50)]).drop("series_id")
    out = with_positions(df, SeriesShape(key=(), step=3600, chunk_rows=8))
    assert ordered(out, "pos", "series_rows", "temp") == [(i, 50, float(i)) for i in range(50)]


def test_no_window_takes_a_whole_series(spark):
    """Lags are windowed per chunk; only the bucket counts of the single series meet in one task."""
    df = hours(spark, [1.0, 2.0, 3.0]).drop("series_id")
    out = add_lags(df, SeriesShape(key=(), step=3600, chunk_rows=2), {"temp": (1,)})
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    windows = [i for i, line in enumerate(lines) if "Window [lag(" in line]
    exchanges = [next(line for line in lines[i:] if "Exchange" in line) for i in windows]
    assert len(exchanges) == 2 and "hashpartitioning(__bucket" in exchanges[0] and "hashpartitioning(__chunk" in exchanges[1]
    gathered = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert gathered and all("__size" in lines[i + 1] or "__bucket" in lines[i + 1] for i in gathered)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def row_shuffles(plan):
    """Shuffles by series and bucket that are run, not read again."""
    return [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line and "ReusedExchange" not in line]


@pytest.mark.parametrize("numbered", [False, True])
def test_rows_are_shuffled_once_and_not_stored(spark, sf, numbered):
    """All branches read one shuffle by series and bucket; the input is scanned once."""
    from loomcast.plans.panels import hourly_panel

    panel = hourly_panel(spark, sf).select("series_id", "ts", "temp")
    out = over_chunks(panel, HOURLY.with_chunk(64), lambda w: [F.lag("temp", 3).over(w).alias("l")], back=3, numbered=numbered)
    plan = final_plan(out)
    assert plan.count("FileScan parquet") == 1 and "events.parquet" in plan
    assert len(row_shuffles(plan)) == 1
    assert plan.count("ReusedExchange") >= 2


def test_a_chunk_of_one_row_and_empty_input(spark):
    df = hours(spark, [float(i) for i in range(9)], step=700)
    out = over_chunks(df, HOURLY.with_chunk(1), lambda w: [F.lag("temp", 4).over(w).alias("l"), F.lead("temp", 2).over(w).alias("n")], 4, 2, True)
    assert ordered(out, "pos", "series_rows", "l", "n") == [
        (i, 9, float(i - 4) if i > 3 else None, float(i + 2) if i < 7 else None) for i in range(9)
    ]
    assert over_chunks(df.where("false"), HOURLY, lambda w: [F.lag("temp", 4).over(w).alias("l")], 4).count() == 0


def test_rows_without_time_come_first(spark):
    rows = [("a", None, 9.0), *[("a", START + timedelta(hours=i), float(i)) for i in range(5)]]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, temp double")
    out = over_chunks(df, HOURLY.with_chunk(2), lambda w: [F.lag("temp", 1).over(w).alias("l")], 1, numbered=True)
    assert ordered(out, "temp", "pos", "l", by="pos") == [(9, 0, None), (0, 1, 9), (1, 2, 0), (2, 3, 1), (3, 4, 2), (4, 5, 3)]


def test_split_sizes_are_truncated(spark):
    out = chronological_split(hours(spark, [float(i) for i in range(20)]), HOURLY)
    counts = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert counts == {"train": 14, "dev": 3, "test": 3}


def test_labels_stay_inside_their_split(spark):
    split = chronological_split(hours(spark, [float(i) for i in range(100)]), HOURLY.with_chunk(16))
    out = add_targets(split, HOURLY.with_chunk(16), "temp", tuple(range(1, 6)), bounded_by="split")
    complete = out.where("`target_temp_t+5` IS NOT NULL")
    assert {r["split"]: r["count"] for r in complete.groupBy("split").count().collect()} == {"train": 65, "dev": 10, "test": 10}
    free = add_targets(split, HOURLY, "temp", (5,))
    assert free.where("`target_temp_t+5` IS NOT NULL").count() == 95


def test_hashed_split_is_repeatable_and_near_its_shares(spark):
    df = spark.range(4000)
    first, again = (hashed_split(df.repartition(n), "id").groupBy("split").count().collect() for n in (3, 7))
    counts = {r["split"]: r["count"] for r in first}
    assert counts == {r["split"]: r["count"] for r in again}
    assert abs(counts["train"] - 2800) < 150 and abs(counts["dev"] - 600) < 100


def test_grid_fills_gaps(spark):
    df = hours(spark, [1.0, 2.0, 3.0], step=5)
    grid = densify(df, HOURLY)
    assert grid.count() == 11 and grid.where("temp IS NOT NULL").count() == 3
    lag = add_lags(grid, HOURLY, {"temp": (5,)})
    assert ordered(lag.where("temp IS NOT NULL"), "temp", "temp_lag5") == [(1, None), (2, 1), (3, 2)]


def test_grid_runs_join_without_gap_or_overlap(spark):
    ends = spark.createDataFrame(
        [("a", START, 0.0), ("a", START + timedelta(hours=2500), 1.0)], "series_id string, ts timestamp_ntz, temp double"
    )
    grid = densify(ends, HOURLY)
    assert grid.count() == 2501 and grid.select("ts").distinct().count() == 2501


def test_grid_keeps_every_row(spark):
    rows = [("a", START, 1.0), ("a", START + timedelta(hours=1, minutes=7), 2.0), ("a", START + timedelta(hours=2), 3.0),
            (None, START, 4.0), (None, START + timedelta(hours=2), 5.0), ("b", None, 6.0)]
    grid = densify(spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, temp double"), HOURLY)
    assert sorted(r["temp"] for r in grid.where("temp IS NOT NULL").collect()) == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    assert grid.count() == 8  # a gap of each series


def test_decomposition_of_trend_and_week(spark):
    week = [3.0, 1.0, -1.0, -3.0, 2.0, -2.0, 0.0]
    df = hours(spark, [0.5 * i + week[i % 7] for i in range(21)])
    out = decompose(df, HOURLY.with_chunk(5))
    rows = ordered(out, "trend", "seasonal", "resid")
    assert [r[0] is None for r in rows] == [True] * 3 + [False] * 15 + [True] * 3
    assert [r[1] for r in rows] == pytest.approx([week[i % 7] for i in range(21)])
    assert all(r[2] == pytest.approx(0, abs=1e-9) for r in rows[3:18])
    assert decompose(hours(spark, [1.0] * 13), HOURLY).count() == 0


@pytest.mark.parametrize("name", ["wn01_lag", "wn03_trailing_mean", "wn06_lead_targets", "wn08_chronological_split", "ud03_hourly_features"])
def test_input_of_windows_is_read_once(spark, sf, name):
    """One scan and one shuffle of the rows, which all branches share; nothing is stored before."""
    from loomcast.plans.queries import QUERIES

    plan = final_plan(QUERIES[name](spark, sf))
    assert plan.count("FileScan parquet") == 1
    assert len(row_shuffles(plan)) == 1


def test_time_range_of_an_hourly_panel_reaches_the_scan(spark, sf):
    from loomcast.plans.panels import hourly_panel

    panel = hourly_panel(spark, sf, "2024-01-15", "2024-01-16").select("series_id", "ts", "temp")
    plan = panel._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].splitlines()[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    whole = hourly_panel(spark, sf).select("series_id", "ts", "temp").where("ts >= '2024-01-15' AND ts < '2024-01-16'")
    assert ordered(panel, "series_id", "ts", "temp") == ordered(whole, "series_id", "ts", "temp")
