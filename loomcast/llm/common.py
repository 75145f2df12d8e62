"""Expressions and helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The six ASCII white-space characters; everything else belongs to a word.
SPACE = " \t\n\x0b\x0c\r"
# Rows of an Arrow batch that a task turns into Python objects at a time.
ROWS = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def whole(text: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words between ASCII white space as an array; none for an empty text."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def packed(docs: DataFrame) -> DataFrame:
    """The rows as one struct column ``row``, so that no name of theirs can meet one of ours."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """All rows in batches of at most ``rows``, so that the objects and matrices made of a batch
    do not grow with Spark's batches, which have 10,000 rows by default."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


_kept: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What tasks that run in this process one after the other share, by key.

    Spark runs the tasks of all stages in the same few processes, so only the latest is kept: the
    words that one operator has learnt would else stay beside those of the next.
    """
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def parallel(df: DataFrame) -> int:
    """Partitions of a shuffle in this session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
