import os
import random
from datetime import timedelta

import pytest
from frames import START, hours
from pyspark.sql import functions as F

from loomcast.operators.chunks import HOURLY
from loomcast.session import scratch_path
from loomcast.spec import build_features, hourly_spec
from loomcast.streaming import jobs
from loomcast.streaming.store import FeatureStore, refresh_features

SCHEMA = "series_id string, ts timestamp_ntz, temp double"


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return jobs.file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, maxFilesPerTrigger="1")


def at(h, v=1.0):
    return ("a", START + timedelta(hours=h), v)


def test_ingest_drops_repeats_and_late_rows_across_a_restart(spark):
    base = scratch_path(spark, "stream")
    put(spark, f"{base}/in", [at(0), at(1), at(1), at(30)])

    def run():
        jobs.run_available(jobs.deduplicated(stream(spark, f"{base}/in"), ["series_id"], "ts", "6 hours"), f"{base}/out", f"{base}/cp")

    run()
    put(spark, f"{base}/in", [at(30), at(26), at(2), at(40)])  # a repeat, a row in time, a late row, a new one
    run()
    run()
    got = sorted(r["ts"] for r in spark.read.parquet(f"{base}/out").collect())
    assert [t.replace(tzinfo=None) - START for t in got] == [timedelta(hours=h) for h in (0, 1, 26, 30, 40)]


def test_rollup_emits_closed_windows_only(spark):
    base = scratch_path(spark, "rollup")
    put(spark, f"{base}/in", [at(0, 1.0), at(5, 3.0), at(23, 2.0), at(30, 9.0)])
    out = jobs.rollup(stream(spark, f"{base}/in"), ["series_id"], "ts", "1 day", "1 hour", [F.count(F.lit(1)).alias("n"), F.avg("temp").alias("temp")])
    jobs.run_available(out, f"{base}/out", f"{base}/cp")
    (row,) = spark.read.parquet(f"{base}/out").collect()
    assert (row["n"], row["temp"]) == (3, 2.0)


def test_feature_stream_equals_the_full_computation(spark):
    base = scratch_path(spark, "features")
    spec = hourly_spec(HOURLY.with_chunk(16))
    values = [float((i * 7) % 13) for i in range(90)]
    rows = [r for s in ("a", "b") for r in hours(spark, values, s).collect()]
    cut = [START + timedelta(hours=h) for h in (40, 60)]
    parts = [[r for r in rows if r["ts"] < cut[0]], [r for r in rows if cut[0] <= r["ts"] < cut[1]], [r for r in rows if r["ts"] >= cut[1]]]
    for i, part in enumerate(parts):
        put(spark, f"{base}/in", part + ([parts[0][-1]] if i == 1 else []))
        jobs.feature_stream(stream(spark, f"{base}/in"), spec, f"{base}/out", f"{base}/cp")
    names = ["series_id", "ts", "temp_lag24h", "temp_lag1h"]
    streamed = spark.read.parquet(f"{base}/out/features").select(*names)
    whole = build_features(spark.createDataFrame(rows, SCHEMA), spec).select(*names)
    assert streamed.count() == whole.count() == 180
    assert streamed.exceptAll(whole).isEmpty() and whole.exceptAll(streamed).isEmpty()


def test_feature_stream_with_late_rows(spark):
    """Rows in any order over the batches: the newest features equal the full computation."""
    base = scratch_path(spark, "late")
    spec = hourly_spec(HOURLY.with_chunk(16))
    rows = [r for s in ("a", "b", None) for r in hours(spark, [float((i * 7) % 13) for i in range(50)], "s").select(F.lit(s).alias("series_id"), "ts", "temp").collect()]
    shuffled = random.Random(5).sample(rows, len(rows))
    for part in (shuffled[:70], shuffled[60:110], shuffled[110:]):
        put(spark, f"{base}/in", part)
        jobs.feature_stream(stream(spark, f"{base}/in"), spec, f"{base}/out", f"{base}/cp")
    names = ["series_id", "ts", "temp", "temp_lag24h", "temp_lag1h"]
    streamed = jobs.current_features(spark, f"{base}/out", spec, spark.createDataFrame([], SCHEMA).schema).select(*names)
    whole = build_features(spark.createDataFrame(rows, SCHEMA), spec).select(*names)
    assert streamed.count() == whole.count() == 150
    assert streamed.exceptAll(whole).isEmpty() and whole.exceptAll(streamed).isEmpty()


def test_batch_ingest(spark):
    stored, incoming = hours(spark, [1.0, 2.0]), hours(spark, [1.0, 2.0, 3.0, 4.0])
    out = jobs.ingest_batch(incoming.unionAll(incoming), stored, ["series_id", "ts"], ["temp"])
    assert sorted(r["temp"] for r in out.collect()) == [3.0, 4.0]


def test_next_stamp(spark):
    assert jobs.next_stamp(hours(spark, [1.0, 2.0]), ["series_id"], "ts", 3600).first()["next_ts"] == START + timedelta(hours=2)


@pytest.mark.parametrize("cut", [3, 30, 50])
def test_refresh_equals_full(spark, cut):
    spec = hourly_spec(HOURLY.with_chunk(10))
    df = hours(spark, [float((i * 5) % 17) for i in range(60)])
    edge = F.lit(START + timedelta(hours=cut)).cast("timestamp_ntz")
    names = ["ts", "temp_lag3h", "temp_lag24h"]
    fresh = refresh_features(df.where(F.col("ts") < edge), df.where(F.col("ts") >= edge), spec).select(*names)
    full = build_features(df, spec).where(F.col("ts") >= edge).select(*names)
    assert fresh.exceptAll(full).isEmpty() and fresh.count() == full.count()


def folders(base, table):
    """(version, bucket) of all data files of a table, with their number."""
    found = {}
    for path, _, files in os.walk(f"{base}/{table}"):
        here = dict(p.split("=") for p in path.split("/") if "=" in p)
        n = sum(f.startswith("part-") for f in files)
        if n and "version" in here:
            at = (int(here["version"]), int(here.get("bucket", -1)))
            found[at] = found.get(at, 0) + n
    return found


def test_a_batch_of_one_series_touches_one_bucket(spark):
    base = scratch_path(spark, "store")
    spec = hourly_spec(HOURLY.with_chunk(64))
    names = [f"s{i}" for i in range(12)]
    rows = [(s, START + timedelta(hours=h), float((h * 7) % 13)) for s in names for h in range(40 * 24)]
    store = FeatureStore(base, spec, spark.createDataFrame([], SCHEMA).schema, buckets=8, period="day")
    store.absorb(spark.createDataFrame(rows, SCHEMA), 0)
    written = folders(base, "observations")
    assert len(written) > 4 and sum(written.values()) == 40 * len(written)
    one = [("s3", START + timedelta(hours=40 * 24 + h), 1.0) for h in range(3)] + [rows[3 * 40 * 24 + 39 * 24]]
    added = store.absorb(spark.createDataFrame(one, SCHEMA), 1)
    assert added.count() == 3  # one row was known
    bucket = spark.createDataFrame(one, SCHEMA).select(store.bucket()).first()[0]
    for table in ("observations", "features", "tail"):
        assert {k: v for k, v in folders(base, table).items() if k[0] == 1} == {(1, bucket): 1}, table
    # What the batch reads: its bucket's tail, and its bucket's rows of the two days it has rows of.
    before = store.index(spark, 0)
    days = [(START + timedelta(days=d)).date() for d in (39, 40)]
    near = store.observations(spark, before, [bucket]).where(F.col("period").isin(days))
    assert len(store.tails(spark, before, [bucket]).inputFiles()) == 1
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan or "PartitionFilters: [period" in plan
    assert near.inputFiles() and all(f"/version=0/bucket={bucket}/" in f for f in near.inputFiles())
    assert near.count() % 24 == 0 and near.count() > 0
    assert {b for b, r in store.index(spark, 1).items() if r["tail"] == 1} == {bucket}


@pytest.mark.parametrize("versions", [1, 3, 50])
def test_store_equals_the_full_computation_in_any_order(spark, versions):
    """Shuffled batches with repeats and a batch that runs twice, with and without merging."""
    base = scratch_path(spark, "store")
    spec = hourly_spec(HOURLY.with_chunk(16))
    rows = [(s, START + timedelta(hours=h), float((h * 7) % 13)) for s in ("a", "b", "c", None) for h in range(45)]
    shuffled = random.Random(versions).sample(rows, len(rows))
    store = FeatureStore(base, spec, spark.createDataFrame([], SCHEMA).schema, buckets=3, period="day", versions=versions)
    parts = [shuffled[:60], shuffled[50:90], shuffled[90:130], [], shuffled[:5], shuffled[130:]]
    for i, part in enumerate(parts):
        store.absorb(spark.createDataFrame(part, SCHEMA), i)
        if i == 2:
            store.absorb(spark.createDataFrame(part, SCHEMA), i)
    index = store.newest(spark)
    assert all(len(r["versions"]) <= versions for r in index.values())
    names = ["series_id", "ts", "temp", "temp_lag24h", "temp_lag1h"]
    stored = store.observations(spark, index, sorted(index))
    assert sorted(stored.select("temp").collect()) == sorted(spark.createDataFrame(rows, SCHEMA).select("temp").collect())
    kept = store.features(spark, index, sorted(index)).select(*names)
    whole = build_features(spark.createDataFrame(rows, SCHEMA), spec).select(*names)
    assert kept.count() == whole.count() == 180
    assert kept.exceptAll(whole).isEmpty() and whole.exceptAll(kept).isEmpty()


def test_late_and_repeated_rows_over_batches(spark):
    base = scratch_path(spark, "late")
    parts = [[at(0), at(1, 5.0), at(1, 3.0), at(30)], [at(30), at(26), at(2), at(40)], [at(40), at(33), at(34), at(35)]]
    for part in parts:
        put(spark, f"{base}/in", part)
        source = jobs.file_stream(spark, f"{base}/in", spark.createDataFrame([], SCHEMA).schema)
        jobs.ingest_stream(source, ["series_id"], "ts", ["temp"], "6 hours", f"{base}/kept", f"{base}/cp1")
        jobs.late_stream(source, "ts", "6 hours", f"{base}/beyond", f"{base}/cp2")
    hour = lambda r: (r["ts"].replace(tzinfo=None) - START) // timedelta(hours=1)
    kept = {hour(r): (r["temp"], r["copies"]) for r in jobs.ingested(spark, f"{base}/kept", ["series_id"], "ts").collect()}
    assert kept == {0: (1.0, 1), 1: (3.0, 2), 30: (1.0, 2), 26: (1.0, 1), 40: (1.0, 2), 35: (1.0, 1)}
    late = sorted(hour(r) for r in jobs.late_rows(spark, f"{base}/beyond").collect())
    assert late == [2, 33, 34]
