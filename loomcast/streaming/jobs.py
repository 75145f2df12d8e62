"""Ingest, live roll-up, monitoring and incremental features."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loomcast.operators.dedup import keep_first, keep_last, only_new
from loomcast.operators.quantiles import quantiles_wide
from loomcast.spec import FeatureSpec
from loomcast.streaming.store import FeatureStore


def file_stream(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.parquet", **options: str) -> DataFrame:
    return spark.readStream.schema(schema).options(pathGlobFilter=pattern, **options).parquet(path)


def timed(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermarked stream; watermarks need a timestamp with zone."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there, then stop; state and progress live in the checkpoint."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


def deduplicated(stream: DataFrame, key: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Each ``(key, ts)`` once; repeats inside the watermark are dropped, later rows are too late."""
    return timed(stream, ts, delay).dropDuplicatesWithinWatermark([*key, ts])


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Hand what is there to ``handle`` batch by batch, then stop."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def ingest_stream(stream: DataFrame, key: Sequence[str], ts: str, order: Sequence[str], delay: str, path: str, checkpoint: str) -> StreamingQuery:
    """Rows once per ``(key, ts)``, the first by ``order`` of all that came in time, with ``copies``.

    The state of a key is kept until the watermark passes its time, so repeats are recognised
    over batches and restarts; a row at or before the watermark is too late and changes nothing.
    Every batch writes the keys it changed to a folder of its own: ``ingested`` takes the newest.
    """
    rest = [c for c in stream.columns if c not in (*key, ts)]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("r")
    kept = timed(stream, ts, delay).groupBy(*key, ts).agg(first, F.count(F.lit(1)).alias("copies"))

    def handle(batch: DataFrame, number: int) -> None:
        batch.select(*key, ts, "r.*", "copies").write.mode("overwrite").parquet(f"{path}/batch={number}")

    return run_batches(kept, handle, checkpoint, "update")


def ingested(spark: SparkSession, path: str, key: Sequence[str], ts: str) -> DataFrame:
    """The rows that ``ingest_stream`` keeps, with the number of times each came."""
    return keep_last(spark.read.parquet(path), [*key, ts], ["batch"]).drop("batch")


def late_stream(
    stream: DataFrame, ts: str, delay: str, path: str, checkpoint: str, closing: Callable[[Column], Column] = lambda c: c
) -> StreamingQuery:
    """Rows that come when the watermark has reached ``closing(ts)``: what stateful queries drop.

    The watermark of a batch is the newest time of the batches before, less the delay; it is
    written with every batch, as are the late rows, so a repeated batch gives the same.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        seen = None if number == 0 else spark.read.parquet(f"{path}/seen/batch={number - 1}").first()["newest"]
        mark = F.lit(seen).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
        batch.where(closing(F.col(ts)) <= mark).write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        newest = F.greatest(F.max(ts), F.lit(seen).cast("timestamp_ntz")).alias("newest")
        batch.agg(newest).write.mode("overwrite").parquet(f"{path}/seen/batch={number}")

    return run_batches(stream, handle, checkpoint)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that ``late_stream`` found, with the batch that brought them."""
    return spark.read.parquet(f"{path}/late")


def ingest_batch(incoming: DataFrame, stored: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Batch twin of the ingest: rows not stored yet, each key once."""
    return only_new(keep_first(incoming, key, order), stored, key)


def rollup(stream: DataFrame, key: Sequence[str], ts: str, length: str, delay: str, aggregates: Sequence[Column]) -> DataFrame:
    """Tumbling windows; a window is emitted when the watermark has passed its end."""
    grouped = timed(stream, ts, delay).groupBy(*key, F.window(ts, length).alias("w"))
    measures = grouped.agg(*aggregates)
    rest = [c for c in measures.columns if c not in (*key, "w")]
    return measures.select(*key, F.col("w.start").alias(ts), *rest)


def next_stamp(df: DataFrame, key: Sequence[str], ts: str, step_seconds: int) -> DataFrame:
    """Time of the row each series waits for."""
    return df.groupBy(*key).agg((F.max(ts) + F.make_dt_interval(secs=F.lit(step_seconds))).alias("next_ts"))


def monitoring(events: DataFrame, length: str = "1 day") -> DataFrame:
    """Requests, errors and latency per window and event type."""
    return events.groupBy(F.window("ts", length).alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.avg("value").alias("latency_mean"),
        F.max("value").alias("latency_max"),
    ).select(F.col("w.start").alias("window_start"), "event_type", "requests", "errors", "latency_mean", "latency_max")


def latency_stream(
    stream: DataFrame, delay: str, probabilities: Sequence[float] = (0.5, 0.95), accuracy: int = 10_000, length: str = "1 day"
) -> DataFrame:
    """Latency quantiles of closed windows per event type from a stream.

    The state of a window and type is a mergeable sketch whose size depends on ``accuracy`` only.
    The rank of a quantile is off by n / accuracy at most; ``latency_quantiles`` is the exact batch form.
    """
    sketch = F.percentile_approx("value", list(probabilities), accuracy).alias("q")
    grouped = timed(stream, "ts", delay).groupBy(F.window("ts", length).alias("w"), "event_type")
    found = grouped.agg(F.count("value").alias("n"), sketch)
    named = [F.col("q")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(probabilities)]
    return found.select(F.col("w.start").alias("window_start"), "event_type", "n", *named)


def latency_quantiles(events: DataFrame, probabilities: Sequence[float] = (0.5, 0.95), length: str = "1 day") -> DataFrame:
    """Exact latency quantiles per window and event type, as one column ``p50``, ``p95`` each."""
    windowed = events.select(F.window("ts", length)["start"].alias("window_start"), "event_type", F.col("value").alias("latency"))
    wide = quantiles_wide(windowed, ["latency"], probabilities, ["window_start", "event_type"])
    named = [F.col(f"q{i}").alias(f"p{round(p * 100)}") for i, p in enumerate(probabilities)]
    return wide.select("window_start", "event_type", "n", *named)


def current_features(spark: SparkSession, path: str, spec: FeatureSpec, schema: T.StructType) -> DataFrame:
    """Features that ``feature_stream`` wrote under ``path``: of each time the newest version."""
    store = FeatureStore(path, spec, schema)
    index = store.newest(spark)
    return store.features(spark, index, sorted(index))


def feature_stream(
    stream: DataFrame,
    spec: FeatureSpec,
    path: str,
    checkpoint: str,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    **cut: object,
) -> StreamingQuery:
    """Take new observations into a ``FeatureStore`` batch by batch, with their features.

    A batch reads and writes the buckets of its own series only. Features of stored rows after a
    late one are written anew: ``current_features`` takes the newest version. ``cut`` sets
    ``buckets``, ``period`` and ``versions`` of the store.
    """
    store = FeatureStore(path, spec, stream.schema, **cut)

    def handle(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            added = store.absorb(batch, number)
            if on_batch:
                on_batch(added, number)
        finally:
            batch.unpersist()

    return run_batches(stream, handle, checkpoint)
