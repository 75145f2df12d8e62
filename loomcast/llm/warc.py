"""WARC archives: one gzip member per record, written and read back sequentially."""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.session import scratch_path, settled

END = b"\r\n"


@dataclass(frozen=True)
class Archives:
    """An archive is closed once it has ``archive_bytes``; payloads of ``least_bytes`` and more
    are stored once. A fixed date makes archives of equal pages equal."""

    archive_bytes: int = 256 * 1024 * 1024
    least_bytes: int = 0
    date: str = "2024-01-01T00:00:00Z"
    chunk: int = 64 * 1024


@dataclass
class Record:
    """One record as read: its header fields, and sizes and digests found while it streamed by."""

    fields: dict[str, str]
    http: dict[str, str]
    block_bytes: int
    payload_bytes: int
    payload_digest: str


class DamagedArchive(ValueError):
    """Framing, length or digest of a record is not what its header says."""


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI with a scheme."""
    if ":/" not in path:
        raise ValueError(f"{path} names no file system; qualify it with qualified_path")
    return fs.FileSystem.from_uri(path)


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path with the scheme and authority that Spark itself would open it by."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    qualified = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    # Hadoop writes a local path with one slash.
    return "file://" + qualified.removeprefix("file:") if qualified.startswith("file:/") and not qualified.startswith("file://") else qualified


def _head(first: str, fields: dict[str, str | int | None]) -> bytes:
    lines = [first, *(f"{k}: {v}" for k, v in fields.items() if v is not None)]
    return "\r\n".join(lines).encode() + END + END


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A response or revisit record, uncompressed. A revisit has the HTTP head alone."""
    digest = base32_sha1(payload)
    http = _head("HTTP/1.1 200 OK", {"Content-Type": "text/html; charset=utf-8", "Content-Length": len(payload)})
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{url}/{digest}')}>",
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else "".join(url.split()),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None,
        "X-Page-Id": page_id,
        "X-Refers-To-Page-Id": refers_to if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    return _head("WARC/1.1", fields) + block + END + END


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:] if line)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def members(stream: BinaryIO, chunk: int) -> Iterator[Iterator[bytes]]:
    """Per gzip member, the pieces of its content, inflated as they are read."""
    rest = stream.read(chunk)

    def pieces(inflate) -> Iterator[bytes]:
        nonlocal rest
        while True:
            out = inflate.decompress(rest, chunk)
            rest = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
            if out:
                yield out
            if inflate.eof:
                return
            if not rest and not out:
                rest = stream.read(chunk)
                if not rest:
                    raise DamagedArchive("the archive ends inside a member")

    while rest or (rest := stream.read(chunk)):
        one = pieces(zlib.decompressobj(wbits=31))
        yield one
        for _ in one:  # whatever the reader of the member has left
            pass


def _verified(named: str | None, found: bytes, what: str) -> None:
    """Compare a digest with the one that a header names; only SHA-1 is known."""
    if named is None or not named.lower().startswith("sha1:"):
        return
    value = named[5:]
    own = found.hex() if len(value) == 40 else base64.b32encode(found).decode()
    if value.upper() != own.upper():
        raise DamagedArchive(what)


def read_record(pieces: Iterator[bytes]) -> Record:
    """Read one member: header, then a block of exactly Content-Length bytes, then two line ends.

    The block is digested piece by piece and never held; digests that the header names are
    verified. A response has an HTTP head before its payload, unless it is not of HTTP; of any
    other type but revisit the payload is the block. A revisit without a length of its payload
    counts what it has.
    """
    held = b""
    while b"\r\n\r\n" not in held:
        piece = next(pieces, None)
        if piece is None:
            raise DamagedArchive("no end of the header")
        held += piece
    head, _, held = held.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise DamagedArchive("not a record")
    fields = _fields(head)
    if not fields.get("content-length", "").isdigit():
        raise DamagedArchive("no Content-Length")
    length, kind = int(fields["content-length"]), fields.get("warc-type", "")
    media = fields.get("content-type", "").replace(" ", "").lower()
    of_http = kind in ("response", "revisit") and (media.startswith("application/http") or not media)
    block, payload, seen, size = hashlib.sha1(), hashlib.sha1(), 0, 0
    http: dict[str, str] | None = None if of_http else {}
    before = b""  # the HTTP head as far as it came
    while True:
        part, held = held[: length - seen], held[length - seen :]
        seen += len(part)
        block.update(part)
        if http is None:
            before += part
            if b"\r\n\r\n" in before:
                http_head, _, part = before.partition(b"\r\n\r\n")
                http = _fields(http_head)
        if http is not None:
            payload.update(part)
            size += len(part)
        if seen == length:
            break
        held = next(pieces, None)
        if held is None:
            raise DamagedArchive("the block is shorter than its Content-Length")
    for piece in pieces:
        held += piece
    if held != END + END:
        raise DamagedArchive("the block is longer than its Content-Length")
    _verified(fields.get("warc-block-digest"), block.digest(), "block digest")
    digest = base64.b32encode(payload.digest()).decode()
    if kind != "revisit":
        _verified(fields.get("warc-payload-digest"), payload.digest(), "payload digest")
    else:  # the payload is that of the record it refers to
        named = (http or {}).get("content-length", "")
        size = int(named) if named.isdigit() else size
        value = fields.get("warc-payload-digest", "")
        digest = value[5:] if value.lower().startswith("sha1:") else digest
    return Record(fields, http or {}, length, size, digest)


def _writer(folder: str, archives: Archives):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _filesystem(folder)
        files.create_dir(root, recursive=True)
        out, name, records, written = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [records], "bytes": [written]})

        for batch in batches:
            for page_id, url, payload, newest, shared in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                revisit = bool(shared) and page_id != newest
                raw = record_bytes(page_id, url, payload, newest, revisit, archives.date)
                if out is None:
                    name, records, written = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(os.path.join(root, name), compression=None)
                deflate = zlib.compressobj(level=4, wbits=31)
                member = deflate.compress(raw) + deflate.flush()
                out.write(member)
                records, written = records + 1, written + len(member)
                if written >= archives.archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return run


def write_archives(pages: DataFrame, archives: Archives = Archives()) -> DataFrame:
    """Write a record per page; returns the stored list of archives (archive, records, bytes).

    Of pages with equal payloads the one with the largest page_id is the response, the others
    revisit it; a null id is smaller than all. Pages that share both payload and page_id are all
    responses. An archive has a name of its own per attempt, so a task that runs again leaves
    the list with the files of the attempt that succeeded.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    shared = settled(
        rows.where(F.octet_length("payload") >= archives.least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("pages"))
        .where("pages > 1")
        .select(F.col("digest").alias("shared_digest"), "newest"),
        "warc-shared",
    )
    marked = rows.join(shared, rows.digest == shared.shared_digest, "left").select(
        "page_id", "url", "payload", "newest", F.col("newest").isNotNull().alias("shared")
    )
    folder = qualified_path(pages.sparkSession, scratch_path(pages.sparkSession, "warc-archives"))
    return settled(marked.mapInArrow(_writer(folder, archives), "archive string, records bigint, bytes bigint"), "warc-list")


def read_archives(listed: DataFrame, archives: Archives = Archives(), page_id_type: str = "bigint") -> DataFrame:
    """Records of the listed archives: page_id, payload_bytes, payload_digest, record_type,
    refers_to, url, block_bytes.

    Archives of other writers are read too: their records have no page_id, and all types of
    record come back with theirs. A damaged record stops the job. ``archive`` is a URI.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "block_bytes"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda x: None if x is None else int(x)
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                files, path = _filesystem(archive)
                rows = []
                with files.open_input_stream(path, compression=None) as stream:
                    for pieces in members(stream, archives.chunk):
                        r = read_record(pieces)
                        rows.append(
                            (
                                number(r.fields.get("x-page-id")),
                                r.payload_bytes,
                                r.payload_digest,
                                r.fields.get("warc-type"),
                                number(r.fields.get("x-refers-to-page-id")),
                                r.fields.get("warc-target-uri"),
                                r.block_bytes,
                            )
                        )
                        if len(rows) == 2000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)

    # An archive is one task's work: they are dealt by name, not gathered.
    return listed.select("archive").repartition("archive").mapInArrow(
        run,
        f"page_id {page_id_type}, payload_bytes bigint, payload_digest string, record_type string, "
        f"refers_to {page_id_type}, url string, block_bytes bigint",
    )


def archive_pages(pages: DataFrame, archives: Archives = Archives()) -> DataFrame:
    """Write all pages and read them back: one row per input row.

    ``page_id`` must be a whole number; a null html is an empty payload, a null url is left out
    of the record; an empty table writes no archive and gives no rows; further columns are not
    read.
    """
    return read_archives(write_archives(pages, archives), archives)
