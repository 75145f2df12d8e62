"""Training-data pipeline: five stages over documents, each written as Parquet and reread."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomcast.llm.chosen_path import keep_one_of_each
from loomcast.llm.mixing import mix_documents
from loomcast.llm.packing import pack
from loomcast.llm.quality import keep_sound
from loomcast.llm.secret_tags import redact_secrets
from loomcast.session import prepare, settled

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_sound(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest doc_id."""
    return keep_one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced."""
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a document as often as it is taken."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 ids."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

# Stages 2, 3 and 5 have no SQL form; tests compare the pipeline with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a folder."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
