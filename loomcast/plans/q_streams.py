"""Queries over streams and incremental jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.operators.chunks import HOURLY
from loomcast.plans.catalog import query, r, rnd, rounded
from loomcast.plans.panels import HOURLY_SQL, hourly_panel
from loomcast.plans.q_windows import trailing_sql
from loomcast.session import scratch_path
from loomcast.sources import schemas
from loomcast.sources.readers import table
from loomcast.spec import hourly_spec
from loomcast.streaming import jobs
from loomcast.streaming.store import refresh_features as refreshed


def _event_stream(spark, folder):
    return jobs.file_stream(spark, folder, schemas.EVENTS, "events.parquet")


@query("in01_stream_ingest", "SELECT event_type, ts, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def stream_ingest(spark, folder):
    """Events through the stream to a table, each ``(event_type, ts)`` once."""
    base = scratch_path(spark, "ingest")
    stream = jobs.deduplicated(_event_stream(spark, folder), ["event_type"], "ts", "2 days")
    jobs.run_available(stream.select("event_type", "ts", "event_id"), f"{base}/table", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/table").select("event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id")


@query("in01_batch_ingest", "SELECT event_type, ts, min(event_id) AS event_id FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1, 2")
def batch_ingest(spark, folder):
    """The same rows arrive twice and half of them are stored already."""
    events = table(spark, folder, "events").select("event_type", "ts", "event_id")
    stored = events.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    return jobs.ingest_batch(events.unionAll(events), stored, ["event_type", "ts"], ["event_id"])


# Arrival of rows in three files: by time, but one hour of the first days comes with the second
# file, and one hour of every day comes again with the next file.
PARTS = ("2024-01-11", "2024-01-21")
DELAY = "2 days"


def _arrivals(spark, folder):
    """The rows of each file in the order of arrival."""
    events = table(spark, folder, "events").select("event_type", "ts", "event_id", "value")
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    part = F.when(F.col("ts") < day(PARTS[0]), 0).when(F.col("ts") < day(PARTS[1]), 1).otherwise(2)
    late = (part == 0) & (F.hour("ts") == 5)
    again = F.when((F.hour("ts") == 7) & (part < 2), part + 1)
    numbers = F.array_compact(F.array(F.when(late, 1).otherwise(part), again))
    placed = events.select("*", F.explode(numbers).alias("arrival"))
    return [placed.where(F.col("arrival") == n).drop("arrival") for n in range(3)]


ARRIVALS_SQL = f"""p AS (SELECT event_type, ts, event_id, value,
  CASE WHEN ts < TIMESTAMP '{PARTS[0]}' THEN 0 WHEN ts < TIMESTAMP '{PARTS[1]}' THEN 1 ELSE 2 END AS part FROM events),
a AS (SELECT * EXCLUDE (part), CASE WHEN part = 0 AND hour(ts) = 5 THEN 1 ELSE part END AS arrival FROM p
  UNION ALL SELECT * EXCLUDE (part), part + 1 FROM p WHERE hour(ts) = 7 AND part < 2),
marks AS (SELECT arrival, max(max(ts)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {DELAY} AS mark
  FROM a GROUP BY arrival)"""


def _in_turn(spark, folder, base, *runs):
    """Put one file after the other and let every stream take it; state lives in the checkpoints."""
    for rows in _arrivals(spark, folder):
        rows.write.mode("append").parquet(f"{base}/in")
        stream = jobs.file_stream(spark, f"{base}/in", rows.schema)
        for run in runs:
            run(stream)


@query(
    "in01_stream_late_rows",
    f"""WITH {ARRIVALS_SQL}, s AS (SELECT a.*, coalesce(ts <= mark, false) AS late FROM a JOIN marks USING (arrival)),
k AS (SELECT event_type, ts, min(event_id) AS event_id, count(*) AS copies FROM s WHERE NOT late GROUP BY ALL)
SELECT 'kept' AS part, event_type, ts, event_id FROM k
UNION ALL SELECT 'repeated', event_type, ts, event_id FROM k WHERE copies > 1
UNION ALL SELECT 'late', event_type, ts, event_id FROM s WHERE late""",
)
def stream_late_rows(spark, folder):
    """Three files, taken in one after the other: rows kept, rows that came again, rows too late."""
    base = scratch_path(spark, "late-rows")

    def ingest(stream):
        rows = stream.select("event_type", "ts", "event_id")
        jobs.ingest_stream(rows, ["event_type"], "ts", ["event_id"], DELAY, f"{base}/kept", f"{base}/kept-checkpoint")
        jobs.late_stream(rows, "ts", DELAY, f"{base}/beyond", f"{base}/late-checkpoint")

    _in_turn(spark, folder, base, ingest)
    kept = jobs.ingested(spark, f"{base}/kept", ["event_type"], "ts").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    of = lambda part, rows: rows.select(F.lit(part).alias("part"), "event_type", "ts", "event_id")
    late = jobs.late_rows(spark, f"{base}/beyond")
    return of("kept", kept).unionByName(of("repeated", kept.where("copies > 1"))).unionByName(of("late", late))


@query(
    "in02_late_rollup",
    f"""WITH {ARRIVALS_SQL}, s AS (SELECT a.*, coalesce(date_trunc('day', ts) + INTERVAL 1 DAY <= mark, false) AS late FROM a JOIN marks USING (arrival)),
final AS (SELECT max(ts) - INTERVAL {DELAY} AS mark FROM a)
SELECT 'window' AS part, event_type, date_trunc('day', ts) AS ts, count(*) AS n, {r('avg(value)')} AS temp FROM s, final
WHERE NOT late AND date_trunc('day', ts) + INTERVAL 1 DAY <= final.mark GROUP BY ALL
UNION ALL SELECT 'late', event_type, date_trunc('day', ts), count(*), {r('avg(value)')} FROM s WHERE late GROUP BY ALL""",
)
def late_rollup(spark, folder):
    """Closed days over three files; rows of a day that was closed before are counted apart."""
    base = scratch_path(spark, "late-rollup")
    measures = [F.count(F.lit(1)).alias("n"), F.avg("value").alias("temp")]

    def roll(stream):
        days = jobs.rollup(stream, ["event_type"], "ts", "1 day", DELAY, measures)
        jobs.run_available(days, f"{base}/days", f"{base}/days-checkpoint")
        end = lambda ts: F.date_trunc("day", ts).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
        jobs.late_stream(stream, "ts", DELAY, f"{base}/beyond", f"{base}/late-checkpoint", end)

    _in_turn(spark, folder, base, roll)
    days = spark.read.parquet(f"{base}/days").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    late = jobs.late_rows(spark, f"{base}/beyond").withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    columns = ("event_type", "ts", "n", rounded("temp"))
    return days.select(F.lit("window").alias("part"), *columns).unionByName(
        late.groupBy("event_type", "ts").agg(*measures).select(F.lit("late").alias("part"), *columns)
    )


@query(
    "in02_live_rollup",
    f"""WITH m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events)
SELECT event_type, date_trunc('day', ts) AS ts, count(*) AS n, {r('avg(value)')} AS temp, max(value) AS tempmax
FROM events, m WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= mark GROUP BY 1, 2""",
)
def live_rollup(spark, folder):
    """Closed days only: a day is written when the watermark has passed its end."""
    base = scratch_path(spark, "rollup")
    measures = [F.count(F.lit(1)).alias("n"), F.avg("value").alias("temp"), F.max("value").alias("tempmax")]
    stream = jobs.rollup(_event_stream(spark, folder), ["event_type"], "ts", "1 day", "1 hour", measures)
    jobs.run_available(stream, f"{base}/table", f"{base}/checkpoint")
    days = spark.read.parquet(f"{base}/table")
    return days.select("event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), "n", rounded("temp"), "tempmax")


@query("in03_next_stamp", "SELECT event_type, date_trunc('hour', max(ts)) + INTERVAL 1 HOUR AS next_ts FROM events GROUP BY 1")
def next_stamp(spark, folder):
    hours = table(spark, folder, "events").select("event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
    return jobs.next_stamp(hours, ["event_type"], "ts", 3600)


@query(
    "in04_monitoring",
    f"""SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS requests, count(*) FILTER (WHERE event_type = 'error') AS errors,
  {r('avg(value)')} AS latency_mean, max(value) AS latency_max FROM events GROUP BY 1, 2""",
)
def monitoring(spark, folder):
    out = jobs.monitoring(table(spark, folder, "events"))
    return out.withColumns({"latency_mean": rnd("latency_mean", 6), "window_start": F.col("window_start").cast("timestamp_ntz")})


@query(
    "in04_latency_quantiles",
    f"""SELECT date_trunc('day', ts) AS window_start, event_type, count(value) AS n,
  {r('quantile_cont(value, 0.5)')} AS p50, {r('quantile_cont(value, 0.95)')} AS p95 FROM events GROUP BY 1, 2""",
)
def latency_quantiles(spark, folder):
    out = jobs.latency_quantiles(table(spark, folder, "events").select("ts", "event_type", "value"))
    start = F.col("window_start").cast("timestamp_ntz").alias("window_start")
    return out.select(start, "event_type", "n", rounded("p50"), rounded("p95"))


LATENCY_ACCURACY = 100


@query(
    "in04_stream_latency",
    """WITH m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events)
SELECT date_trunc('day', ts) AS window_start, event_type, count(value) AS n, true AS p50_within, true AS p95_within
FROM events, m WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= mark GROUP BY 1, 2""",
)
def stream_latency(spark, folder):
    """Sketched quantiles of closed days, and whether their exact ranks are as near as stated."""
    base = scratch_path(spark, "latency")
    stream = jobs.latency_stream(_event_stream(spark, folder), "1 hour", accuracy=LATENCY_ACCURACY)
    jobs.run_available(stream, f"{base}/table", f"{base}/checkpoint")
    found = spark.read.parquet(f"{base}/table").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    events = table(spark, folder, "events").select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start"), "event_type", "value")
    ranks = []
    for name in ("p50", "p95"):
        ranks += [F.count_if(F.col("value") < F.col(name)).alias(f"{name}_under"), F.count_if(F.col("value") <= F.col(name)).alias(f"{name}_upto")]
    counted = events.join(found, ["window_start", "event_type"]).groupBy("window_start", "event_type", "n").agg(*ranks)
    checks = []
    for name, p in (("p50", 0.5), ("p95", 0.95)):
        slack = F.col("n") / LATENCY_ACCURACY + 1
        wanted = F.col("n") * p
        checks.append(((F.col(f"{name}_under") <= wanted + slack) & (F.col(f"{name}_upto") >= wanted - slack)).alias(f"{name}_within"))
    return counted.select("window_start", "event_type", "n", *checks)


@query(
    "in05_refresh_features",
    f"""WITH {HOURLY_SQL}, f AS (SELECT series_id, ts, {r('lag(temp, 24) OVER (PARTITION BY series_id ORDER BY ts)')} AS temp_lag24h,
  {trailing_sql('precip', 'avg', 24, 'precip_roll_mean_24h')} FROM h)
SELECT * FROM f WHERE ts >= TIMESTAMP '2024-01-25'""",
)
def refresh_features(spark, folder):
    """Features of the last days from those days and the 24 rows before them."""
    panel = hourly_panel(spark, folder)
    cut = F.lit("2024-01-25").cast("timestamp_ntz")
    out = refreshed(panel.where(F.col("ts") < cut), panel.where(F.col("ts") >= cut), hourly_spec(HOURLY))
    return out.select("series_id", "ts", rounded("temp_lag24h"), rounded("precip_roll_mean_24h"))


# Rows that arrive late: one hour of the day from the 20th on, among rows that are stored already.
LATE = "ts >= TIMESTAMP_NTZ '2024-01-25' OR (ts >= TIMESTAMP_NTZ '2024-01-20' AND hour(ts) = 5)"


@query(
    "in05_late_rows",
    f"""WITH {HOURLY_SQL}, f AS (SELECT series_id, ts, {r('lag(temp, 24) OVER (PARTITION BY series_id ORDER BY ts)')} AS temp_lag24h,
  {trailing_sql('precip', 'avg', 24, 'precip_roll_mean_24h')} FROM h),
since AS (SELECT series_id, min(ts) AS since FROM h WHERE {LATE.replace('TIMESTAMP_NTZ', 'TIMESTAMP')} GROUP BY 1)
SELECT f.* FROM f JOIN since USING (series_id) WHERE ts >= since""",
)
def late_rows(spark, folder):
    """Features after rows that lie between stored ones: later stored rows are computed anew."""
    panel = hourly_panel(spark, folder)
    late = F.expr(LATE)
    out = refreshed(panel.where(~late), panel.where(late), hourly_spec(HOURLY))
    return out.select("series_id", "ts", rounded("temp_lag24h"), rounded("precip_roll_mean_24h"))
