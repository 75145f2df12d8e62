"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Panels carry zone-less timestamps; one fixed zone keeps casts stable.
    "spark.sql.session.timeZone": "UTC",
    # Feature tables are wider than the default limit for generated code.
    "spark.sql.codegen.maxFields": "400",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str, cpus: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Local session for tests and benchmarks; on a cluster the submitter builds it."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LOOMCAST_DRIVER_MEMORY", "8g"))
    )
    for name, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else built."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


_own_folders: dict[str, str] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    A folder of our own is made only where the setting is absent and driver and executors are
    one process; a cluster without the setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        application = spark.sparkContext.applicationId
        if application not in _own_folders:
            _own_folders[application] = tempfile.mkdtemp(prefix="loomcast-")
        base = _own_folders[application]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settled(df: DataFrame, label: str) -> DataFrame:
    """The frame written as a table in the shared folder and read back.

    What is derived from it reads the table instead of the raw input again, survives the loss
    of executors, and is planned with the table's true size: the optimizer broadcasts it in a
    join only where that size is under its own threshold.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
