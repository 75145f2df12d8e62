"""Document fingerprints: threshold-scaled sketches of word shingles."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomcast.llm.common import parallel, whole
from loomcast.session import settled

BITS = 48


@dataclass(frozen=True)
class Sketch:
    """Shingles of ``words`` words; hashes below 1 / ``scale`` of their range are retained."""

    words: int = 5
    scale: int = 8


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Mixed hashes of all runs of ``width`` words; a shorter text is one run, an empty one none."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
        out ^= out >> np.uint64(29)
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def retained(text: str, sketch: Sketch) -> np.ndarray:
    """Sorted distinct hashes below the threshold, and the smallest hash whatever its size, so
    that a short text is never without any."""
    values = shingle_hashes(word_hashes(text), sketch.words) >> np.uint64(64 - BITS)
    if not len(values):
        return values
    limit = np.uint64((1 << BITS) // sketch.scale)
    low = values[values < limit]
    return np.unique(low) if len(low) else values.min(keepdims=True)


def fingerprint(values: np.ndarray) -> str:
    """Text form: six bytes, big end first, per hash in base64."""
    return base64.b64encode(values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def parse(text: str) -> np.ndarray:
    """Hashes of a fingerprint in text form."""
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.view(">u8").ravel().astype(np.uint64)


def merged(a: np.ndarray, b: np.ndarray, sketch: Sketch = Sketch()) -> np.ndarray:
    """Fingerprint of the union of two shingle sets."""
    both = np.union1d(a, b)
    low = both[both < np.uint64((1 << BITS) // sketch.scale)]
    return low if len(low) else both[:1]


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the smaller set that lies in the larger; two empty sets are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def edited(text: str, following: str) -> str:
    """The text whose last half is replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_neighbour(docs: DataFrame) -> DataFrame:
    """Rows in buckets of ascending doc_id; each bucket also has the first row of the next one.

    Columns bucket, guest (the row belongs to another bucket), doc_id, text. Texts move once;
    the borders are quantiles of the ids, one per shuffle partition. The last bucket's guest is
    the first row of all.
    """
    n = parallel(docs)
    rows = docs.select("doc_id", whole().alias("text"), F.col("doc_id").cast("double").alias("__at"))
    cuts = rows.agg(F.percentile_approx("__at", [k / n for k in range(1, n)] or [0.5], 10_000)).first()[0] or []
    splits = [-float("inf"), *sorted(set(cuts) or {0.0}), float("inf")]
    cutter = Bucketizer(splits=splits, inputCol="__at", outputCol="__bucket", handleInvalid="keep")
    numbers = rows.withColumn("__at", F.coalesce("__at", F.lit(float("nan"))))  # null ids: the last bucket
    placed = cutter.transform(numbers).select("doc_id", "text", F.col("__bucket").cast("int").alias("bucket"))
    firsts = placed.groupBy("bucket").agg(F.min("doc_id").alias("first_id"))
    in_order = Window.orderBy("bucket")
    whole_table = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("bucket").over(in_order), F.last("bucket").over(whole_table))
    edges = settled(
        firsts.select(F.col("bucket").alias("b"), F.col("first_id"), before.alias("before")), "sketch-edges"
    )
    guests = (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    guest = F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("bucket"), F.lit(True).alias("guest")))
    spread = placed.join(edges, guests, "left").select(
        F.explode(F.array_compact(F.array(own, guest))).alias("x"), "doc_id", "text"
    )
    return spread.select("x.bucket", "x.guest", "doc_id", "text")


def _compared(sketch: Sketch):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = None, None  # the row that waits for its neighbour; a bucket whose guest has come
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(k).to_pylist() for k in range(4)]
            for bucket, guest, doc_id, text in zip(*columns, strict=True):
                if bucket == done:
                    continue  # further copies of the guest row
                values = retained(text, sketch)
                if held is not None:
                    old_id, old_text, old_values = held
                    changed = edited(old_text, text)
                    of_changed = retained(changed, sketch)
                    out.append(
                        (
                            old_id,
                            len(old_text),
                            hashlib.sha256(changed.encode()).hexdigest(),
                            fingerprint(old_values),
                            fingerprint(of_changed),
                            containment(old_values, of_changed),
                            containment(old_values, values),
                        )
                    )
                held = None if guest else (doc_id, text, values)
                done = bucket if guest else None
            if out:
                kinds = [batch.schema.field(2).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names
                )

    return run


def fingerprint_documents(docs: DataFrame, sketch: Sketch = Sketch()) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, with likenesses.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next, one row per input row. Ascending ids decide the next document, null ids come
    last, rows of one id are ordered by text; the first follows the last, and a single document
    follows itself. A null text is empty: its fingerprint is empty, like another empty one
    (likeness 1) and unlike all others (0). ``doc_id`` must be a number; columns besides doc_id
    and text are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    spread = with_neighbour(docs)
    dealt = spread.repartition(parallel(docs), "bucket").sortWithinPartitions(
        "bucket", "guest", F.col("doc_id").asc_nulls_last(), "text"
    )
    return dealt.mapInArrow(
        _compared(sketch),
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
