import pytest
from frames import hours
from pyspark.sql import functions as F

from loomcast.session import scratch_path, settled
from loomcast.sources import readers, schemas, writers


@pytest.fixture()
def base(spark):
    return scratch_path(spark, "sources")


def metrics(spark):
    rows = [(h, 0.5 * h, 0.7 * h, 2.0, 0.9, 10) for h in range(1, 13)]
    return spark.createDataFrame(rows, "horizon int, mae double, rmse double, mape double, r2 double, n_samples bigint")


def test_observations_from_text(spark, base):
    names = [f.name for f in schemas.HOURLY_OBSERVATIONS.fields]
    rows = [
        {"name": "Here", "datetime": "2025-11-12T01:00:00", "temp": "22", "humidity": "NaN", "icon": "cloudy"},
        {"name": "Here", "datetime": "2025-11-12T00:00:00", "temp": "21.5", "humidity": "80.1", "icon": ""},
    ]
    spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"{n} string" for n in names)).write.option(
        "header", True
    ).csv(base)
    df = readers.read_observations(spark, base, schemas.HOURLY_OBSERVATIONS)
    assert dict(df.dtypes)["ts"] == "timestamp_ntz" and dict(df.dtypes)["temp"] == "double"
    got = [(r["series_id"], r["temp"], r["humidity"], r["icon"]) for r in df.orderBy("ts").collect()]
    assert got == [("Here", 21.5, 80.1, None), ("Here", 22.0, None, "cloudy")]
    assert "preciptype" in df.columns and "datetime" not in df.columns
    assert readers.feature_contract(df, ("series_id", "ts"))[0] == "temp"


def test_split_table_reads_one_partition(spark, base):
    df = hours(spark, [1.0, 2.0, 3.0, 4.0]).withColumns({"split": F.when(F.col("temp") < 3, "train").otherwise("test"), "horizon": F.lit(3)})
    writers.write_split_tables(df, base, ("split", "horizon"))
    part = readers.read_split(spark, base, "train", 3)
    assert part.count() == 2
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_metrics_as_json_and_csv(spark, base):
    writers.write_metrics(metrics(spark), f"{base}/json", f"{base}/table")
    rows = {r["target"]: (r["hour"], r["MAE"], r["RMSE"]) for r in readers.read_metrics_json(spark, f"{base}/json").collect()}
    assert len(rows) == 12 and rows["t+10h"] == (10, 5.0, 7.0)
    nested = spark.read.schema(schemas.HOURLY_METRICS).json(f"{base}/json").first()
    assert nested["average_metrics"]["MAE"] == pytest.approx(3.25)
    writers.write_metrics_csv(metrics(spark), f"{base}/csv")
    flat = readers.read_metrics_csv(spark, f"{base}/csv")
    assert flat.where("target = 't+4'").first()["RMSE"] == pytest.approx(2.8)


def test_tuning_results_from_json(spark, base):
    text = '{"t+2h": {"model": "M", "n_features": 3, "params": {"depth": 4, "rate": 0.1}, "best_rmse": 0.9},\n "t+1h": {"model": "N", "params": {}}}'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(base)
    rows = {r["horizon"]: r for r in readers.read_tuning_json(spark, base).collect()}
    assert rows[2]["params"] == {"depth": "4", "rate": "0.1"} and rows[2]["best_rmse"] == 0.9 and rows[1]["model"] == "N"


def test_export(spark):
    df = hours(spark, [1.0, float("inf")])
    rows = [r["record"] for r in writers.export_records(df, ["series_id"], "ts").orderBy("ts").collect()]
    assert rows == ['{"series_id":"a","ts":"2024-01-01T00:00:00","temp":1.0}', '{"series_id":"a","ts":"2024-01-01T01:00:00","temp":null}']
    envelope = writers.export_envelope(df, ["series_id"], "ts").first()
    assert envelope[:] == ("a", 2, "2024-01-01T00:00:00", "2024-01-01T01:00:00")


def test_log_rows_are_appended(spark, base):
    for _ in range(2):
        writers.append_rows(metrics(spark), base)
    assert spark.read.parquet(base).count() == 24


def test_first_per_time_and_range(spark):
    df = hours(spark, [1.0, 2.0]).unionAll(hours(spark, [5.0])).withColumn("line", F.col("temp"))
    kept = readers.first_per_time(df, ["line"])
    assert {r["temp"] for r in kept.collect()} == {1.0, 2.0}
    assert readers.time_range(df, "ts", "2024-01-01T01:00:00", "2024-01-01T02:00:00").count() == 1


def test_scratch_follows_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    assert path.startswith(base if base else "/")
    assert settled(hours(spark, [1.0]), "y").count() == 1


class WithoutSetting:
    """A session that names no shared folder."""

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"applicationId": "app-without-setting", "master": master})

    class conf:
        get = staticmethod(lambda name, default: default)


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_own_scratch_folder_where_nothing_is_set(master):
    session = WithoutSetting(master)
    first, second = scratch_path(session, "a"), scratch_path(session, "a")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,1024]"])
def test_a_cluster_must_name_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(WithoutSetting(master), "a")
