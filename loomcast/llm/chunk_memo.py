"""Fill-in-middle transformation over memoised content-defined chunks.

A rolling hash cuts the bytes of a text into chunks whose ends depend on the bytes before them
only, so documents that share a passage share its chunks. What a chunk adds to a document (lines,
code points, marks, its edge bytes) is summed up once and kept in a bounded cache; a hit counts
only if the cached content is equal. Adding up the summaries of a document gives its lines and
marks, and prefix sums over them name the chunks that the cuts fall in; only those are searched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = (b"<P>", b"<S>", b"<M>")
_CONTINUATION = bytes(range(0x80, 0xC0))
_SEGMENT = 1 << 20
_REACH = 32  # bytes that a rolling hash of 32 bits covers


@dataclass(frozen=True)
class MiddleOut:
    """``rate`` of 100 documents are transformed, ``suffix_first`` of 100 of these with the suffix first.

    Chunks have ``least`` to ``most`` bytes and about ``least + 2**mean_bits`` in the mean;
    ``cached_bytes`` bounds the cache of a task, which starts anew when it is full.
    """

    seed: int = 7
    rate: int = 100
    suffix_first: int = 50
    least: int = 256
    mean_bits: int = 10
    most: int = 8192
    cached_bytes: int = 64 << 20
    digest_bits: int = 64


def _gear() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(27))) >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def rolling_hashes(data: bytes) -> np.ndarray:
    """Hash of the last 32 bytes (or all, at the start) at every byte, by doubling the window."""
    value = GEAR[np.frombuffer(data, np.uint8)]
    reach = 1
    while reach < _REACH:
        value[reach:] = value[reach:] + (value[:-reach] << np.uint32(reach))
        reach *= 2
    return value


def chunk_ends(data: bytes, params: MiddleOut) -> list[int]:
    """Ends of the chunks of a text; the last is its length."""
    size, last, ends = len(data), 0, []
    if size > params.least:
        shift = np.uint32(32 - params.mean_bits)
        for at in range(0, size, _SEGMENT):
            before = min(at, _REACH - 1)
            marked = np.flatnonzero((rolling_hashes(data[at - before : at + _SEGMENT]) >> shift)[before:] == 0)
            for end in (marked + at + 1).tolist():
                while end - last > params.most:
                    last += params.most
                    ends.append(last)
                if end - last >= params.least:
                    last = end
                    ends.append(end)
    while size - last > params.most:
        last += params.most
        ends.append(last)
    if last < size:
        ends.append(size)
    return ends


class Summary(NamedTuple):
    """What a chunk adds to its document."""

    breaks: int
    chars: int
    marked: bool
    head: bytes
    tail: bytes


def code_points(data: bytes) -> int:
    return len(data.translate(None, _CONTINUATION))


def summary_of(chunk: bytes) -> Summary:
    return Summary(chunk.count(b"\n"), code_points(chunk), any(m in chunk for m in MARKS), chunk[:2], chunk[-2:])


class ChunkCache:
    """Summaries by digest; the content beside them decides whether a digest is a hit."""

    def __init__(self, params: MiddleOut):
        self.mask = (1 << params.digest_bits) - 1
        self.most = params.cached_bytes
        self.held = self.hits = self.misses = 0
        self.known: dict[int, list[tuple[bytes, Summary]]] = {}

    def summary(self, chunk: bytes) -> Summary:
        digest = xxhash.xxh3_64_intdigest(chunk) & self.mask
        for content, found in self.known.get(digest, ()):
            if content == chunk:
                self.hits += 1
                return found
        self.misses += 1
        found = summary_of(chunk)
        if self.held + len(chunk) > self.most:
            self.known.clear()
            self.held = 0
        self.known.setdefault(digest, []).append((chunk, found))
        self.held += len(chunk)
        return found


class Layout:
    """Lines, code points and marks of a text, put together from the summaries of its chunks."""

    def __init__(self, data: bytes, cache: ChunkCache, params: MiddleOut):
        self.data = data
        self.ends = chunk_ends(data, params)
        starts = [0, *self.ends[:-1]]
        parts = [cache.summary(data[a:b]) for a, b in zip(starts, self.ends, strict=False)]
        self.breaks = np.cumsum([p.breaks for p in parts], dtype=np.int64)
        self.chars = np.cumsum([p.chars for p in parts], dtype=np.int64)
        newlines = int(self.breaks[-1]) if parts else 0
        self.lines = newlines + (not data.endswith(b"\n") if data else 0)
        self.marked, tail = False, b""
        for p in parts:
            # A mark may lie across the border of chunks.
            across = tail + p.head
            self.marked |= p.marked or any(m in across for m in MARKS)
            tail = (tail + p.tail)[-2:]

    def cut(self, line: int) -> tuple[int, int]:
        """Bytes and code points of the first ``line`` lines."""
        if line == 0 or not self.ends:
            return 0, 0
        if line == self.lines:
            return len(self.data), int(self.chars[-1])
        k = int(np.searchsorted(self.breaks, line))
        start = self.ends[k - 1] if k else 0
        at = start - 1
        for _ in range(line - (int(self.breaks[k - 1]) if k else 0)):
            at = self.data.index(b"\n", at + 1)
        chars = int(self.chars[k - 1]) if k else 0
        return at + 1, chars + code_points(self.data[start : at + 1])


def draws(doc_id: str, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def transformed(data: bytes, doc_id: str, cache: ChunkCache, params: MiddleOut) -> tuple[int, str, int | None, int | None, bytes]:
    """Lines, form, code points of prefix and middle, and the text in its new order."""
    layout = Layout(data, cache, params)
    h1, h2, h3, h4 = draws(doc_id, params.seed)
    n = layout.lines
    if not data or layout.marked or h3 % 100 >= params.rate:
        return n, "plain", None, None, data
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, prefix_chars = layout.cut(first)
    b, until = layout.cut(second)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    if h4 % 100 < params.suffix_first:
        return n, "spm", prefix_chars, until - prefix_chars, b"<S>" + suffix + b"<P>" + prefix + b"<M>" + middle
    return n, "psm", prefix_chars, until - prefix_chars, b"<P>" + prefix + b"<S>" + suffix + b"<M>" + middle


def _mapped(params: MiddleOut):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = ChunkCache(params)
        for batch in batches:
            # A few texts at a time: the new texts are as long as the old ones.
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                found = [
                    transformed(t.as_py(), i.as_py(), cache, params)
                    for t, i in zip(rows.column("data"), rows.column("name"), strict=True)
                ]
                n, form, prefix, middle, output = (list(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(prefix, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.array(output, pa.binary()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def fill_in_middle(docs: DataFrame, params: MiddleOut = MiddleOut()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output, the text in its new order, per row.

    A null text is empty; an empty text and one that holds a mark are plain. A null doc_id draws
    like an empty one, so repeated rows give equal results. Texts are whole whatever their
    length; an empty table gives no rows; columns besides doc_id and text are not read. Nothing
    is shuffled: the cache of a task only saves work, so a task that runs again gives the same.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("data"),
    )
    schema = f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary"
    return rows.mapInArrow(_mapped(params), schema).withColumn("output", F.col("output").cast("string"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text of before, rebuilt from output and form alone."""

    def between(start: str | None, end: str | None) -> Column:
        at = F.locate(start, F.col(output)) + 3
        return F.substring(F.col(output), at, F.locate(end, F.col(output)) - at) if end else F.substring(F.col(output), at, F.length(output))

    middle = between("<M>", None)
    psm = F.concat(between("<P>", "<S>"), middle, between("<S>", "<M>"))
    spm = F.concat(between("<P>", "<M>"), middle, between("<S>", "<P>"))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
