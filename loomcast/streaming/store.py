"""Incremental observations and features: tables by version, series bucket and period.

Series are dealt to ``buckets`` by a hash, rows to periods of time. Every batch writes one version
of three tables, ``observations``, ``features`` and ``tail`` (the newest rows of each series, all
that features of later rows look back on), with folders only for the buckets it has rows of. A
small index, one row per bucket, names the versions that hold a bucket; it is written last, so a
batch that failed half-way left nothing that is read, and a repeated batch replaces its files. A
batch reads the tails of its own buckets, and stored rows of its own buckets and periods against
repeats; only buckets with late rows read older periods. When a bucket has gathered ``versions``
versions, the batch that touches it next writes its rows together as one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcast.operators.chunks import null_safe_join
from loomcast.operators.dedup import keep_first, keep_last, only_new
from loomcast.operators.topk import latest_rows
from loomcast.spec import FeatureSpec, build_features

BUCKET, PERIOD, ARRIVED = "bucket", "period", "arrived"
INDEX_SCHEMA = f"{BUCKET} int, versions array<bigint>, tail bigint"


def halo_rows(stored: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Stored rows that features of later rows look back on: the newest ones per series."""
    return latest_rows(stored, list(spec.shape.key), spec.shape.ts, spec.history_rows)


def refresh_features(stored: DataFrame, fresh: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Features of every row from the earliest fresh one of its series on.

    Fresh rows may lie between stored ones: stored rows after them are computed anew, on the
    rows that the specification looks back on before the earliest fresh row. Equal to the full
    computation for these rows; series without fresh rows are left out.
    """
    key, ts = list(spec.shape.key), spec.shape.ts
    since = fresh.groupBy(*key).agg(F.min(ts).alias("__since"))
    touched = null_safe_join(stored, since, key)
    before = halo_rows(touched.where(F.col(ts) < F.col("__since")), spec)
    after = touched.where(F.col(ts) >= F.col("__since"))
    both = before.unionByName(after).unionByName(null_safe_join(fresh, since, key))
    return build_features(both, spec).where(F.col(ts) >= F.col("__since")).drop("__since")


@dataclass(frozen=True)
class FeatureStore:
    """Where the tables are and how they are cut.

    ``buckets`` and ``period`` (a unit of ``date_trunc``) must stay as they are for a path.
    """

    path: str
    spec: FeatureSpec
    schema: T.StructType
    buckets: int = 32
    period: str = "month"
    versions: int = 8

    @property
    def key(self) -> list[str]:
        return list(self.spec.shape.key)

    @property
    def ts(self) -> str:
        return self.spec.shape.ts

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int") if self.key else F.lit(0)

    def placed(self, df: DataFrame) -> DataFrame:
        """Rows with the bucket and the period they belong to."""
        return df.withColumns({BUCKET: self.bucket(), PERIOD: F.date_trunc(self.period, self.ts).cast("date")})

    def index(self, spark: SparkSession, version: int) -> dict[int, Row]:
        """What is live after a version: at most one row per bucket. Nothing is before version 0."""
        if version < 0:
            return {}
        return {r[BUCKET]: r for r in spark.read.schema(INDEX_SCHEMA).parquet(f"{self.path}/index/version={version}").collect()}

    def newest(self, spark: SparkSession) -> dict[int, Row]:
        versions = spark.read.parquet(f"{self.path}/index").agg(F.max("version")).first()[0]
        return self.index(spark, versions)

    def _read(self, spark: SparkSession, table: str, schema: T.StructType | None, live: Sequence[tuple[int, int]]) -> DataFrame:
        """Rows of the folders (version, bucket); their version is a column."""
        parts = [T.StructField("version", T.LongType()), T.StructField(BUCKET, T.IntegerType()), T.StructField(PERIOD, T.DateType())]
        if not live:
            return spark.createDataFrame([], T.StructType([*schema.fields, *parts]))
        folders = [f"{self.path}/{table}/version={v}/{BUCKET}={b}" for v, b in live]
        reader = spark.read.option("basePath", f"{self.path}/{table}")
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, *parts]))
        return reader.parquet(*folders)

    def _live(self, index: dict[int, Row], buckets: Sequence[int]) -> list[tuple[int, int]]:
        return [(v, b) for b in buckets if b in index for v in index[b]["versions"]]

    def observations(self, spark: SparkSession, index: dict[int, Row], buckets: Sequence[int]) -> DataFrame:
        """Stored rows of some buckets, with ``arrived``, the batch that brought them."""
        return self._read(spark, "observations", self._stored_schema(), self._live(index, buckets))

    def tails(self, spark: SparkSession, index: dict[int, Row], buckets: Sequence[int]) -> DataFrame:
        return self._read(spark, "tail", self.schema, [(index[b]["tail"], b) for b in buckets if b in index])

    def features(self, spark: SparkSession, index: dict[int, Row], buckets: Sequence[int]) -> DataFrame:
        """Features of some buckets: of each time the newest version."""
        written = self._read(spark, "features", None, self._live(index, buckets))
        return keep_last(written, [*self.key, self.ts], ["version"]).drop("version", BUCKET, PERIOD)

    def _stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(ARRIVED, T.LongType())])

    def _write(self, df: DataFrame, table: str, version: int) -> None:
        """One version of a table: a folder per bucket and period, each written by one task or
        several if the rows are many."""
        placed = self.placed(df).repartition(BUCKET, PERIOD)
        placed.write.mode("overwrite").partitionBy(BUCKET, PERIOD).parquet(f"{self.path}/{table}/version={version}")

    def absorb(self, batch: DataFrame, number: int) -> DataFrame:
        """Take in a batch; returns the rows that were new. A repeated batch gives the same."""
        spark = batch.sparkSession
        names = [*self.key, self.ts]
        rest = [c for c in self.schema.names if c not in names]
        before = self.index(spark, number - 1)
        first = self.placed(keep_first(batch.select(*self.schema.names), names, rest)).persist()
        try:
            # One row per bucket and period of the batch.
            parts = first.select(BUCKET, PERIOD).distinct().collect()
            touched = sorted({r[BUCKET] for r in parts})
            periods = sorted({r[PERIOD] for r in parts if r[PERIOD] is not None})
            near = self.observations(spark, before, touched)
            near = near.where(F.col(PERIOD).isin(periods) | F.col(PERIOD).isNull()) if periods else near
            fresh = only_new(first.drop(BUCKET, PERIOD), near.select(*self.schema.names), names).withColumn(ARRIVED, F.lit(number).cast("long"))
            merged = [b for b in touched if b in before and len(before[b]["versions"]) >= self.versions]
            kept = self.observations(spark, before, merged).select(*self.schema.names, ARRIVED) if merged else None
            self._write(fresh.unionByName(kept) if merged else fresh, "observations", number)
            written = spark.read.schema(self._stored_schema()).parquet(f"{self.path}/observations/version={number}")
            added = written.where(F.col(ARRIVED) == number).select(*self.schema.names)
        finally:
            first.unpersist()
        tail = self.tails(spark, before, touched).select(*self.schema.names)
        refreshed = refresh_features(self._with_late_series(tail, before, touched, added), added, self.spec)
        if merged:
            old = self.features(spark, before, merged)
            refreshed = refreshed.unionByName(only_new(old, refreshed.select(*names), names), allowMissingColumns=True)
        self._write(refreshed, "features", number)
        self._write_tail(tail.unionByName(added), number)
        # A bucket whose rows were all repeats has no folder in this version.
        found = {r[BUCKET] for r in self.placed(added).select(BUCKET).distinct().collect()}
        after = dict(before)
        for b in touched:
            live = [] if b in merged or b not in before else list(before[b]["versions"])
            if b in found or b in merged:
                tail_version = number if b in found or b in before else before[b]["tail"]
                after[b] = Row(bucket=b, versions=[*live, number], tail=tail_version)
        rows = [(b, r["versions"], r["tail"]) for b, r in sorted(after.items())]
        spark.createDataFrame(rows, INDEX_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/index/version={number}")
        return added

    def _write_tail(self, rows: DataFrame, number: int) -> None:
        self.placed(halo_rows(rows, self.spec)).drop(PERIOD).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(
            f"{self.path}/tail/version={number}"
        )

    def _with_late_series(self, tail: DataFrame, before: dict[int, Row], touched: Sequence[int], added: DataFrame) -> DataFrame:
        """The tails, but all stored rows for series with rows that are not after their tail."""
        newest = tail.groupBy(*self.key).agg(F.max(self.ts).alias("__newest"))
        late = null_safe_join(added, newest, self.key).where(F.col(self.ts) <= F.col("__newest")).select(*self.key).distinct()
        buckets = sorted(r[BUCKET] for r in late.select(self.bucket().alias(BUCKET)).distinct().collect())
        if not buckets:
            return tail
        stored = self.observations(late.sparkSession, before, buckets).select(*self.schema.names)
        return null_safe_join(tail, late, self.key, "left_anti").unionByName(null_safe_join(stored, late, self.key, "left_semi"))
