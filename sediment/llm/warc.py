"""WARC archives of pages: written one gzip member per record, read back sequentially.

Of records with equal payloads of at least `min_revisit_bytes` bytes, the one with the smallest
id is a response and the others are revisits that refer to it; only digests and ids are
shuffled to find them. Each task writes an archive of its own under a name that is used once;
what it wrote counts only if the task succeeds and its name arrives in the manifest, so lost
or repeated tasks leave no trace in the result.

The reader takes one archive per task as a stream: pieces of a file are decompressed as they
come, each gzip member is one record, the header ends at the empty line, Content-Length says
how long the block is, and the payload's SHA-256 must equal the one in the header. A damaged or
truncated archive raises `DamagedArchive`. Memory holds one record at most.

Defined results: a null or empty html is a response with an empty payload; a null id is written
as such, is never referred to, and its record is a revisit if its payload repeats; rows that
repeat the smallest id of a payload are responses too; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import arrow_map, quoted
from sediment.session import scratch_dir
from sediment.sinks.staging import staged

GZIP = 16 + zlib.MAX_WBITS
READ_BYTES = 1 << 18
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


class DamagedArchive(ValueError):
    """Bytes that are not a sequence of whole, unchanged records."""


class Record(NamedTuple):
    header: dict[str, str]
    payload_bytes: int
    payload_digest: str
    payload: bytes | None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member."""
    revisit = refers_to is not None
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    header = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url or '', safe='''!#$%&'()*+,/:;=?@[]~''')}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        header += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return packer.compress("\r\n".join(header).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


class _RecordParser:
    """Takes a record's bytes as they come."""

    def __init__(self, with_payload: bool) -> None:
        self.head = bytearray()
        self.header: dict[str, str] | None = None
        self.http = bytearray()
        self.in_payload = False
        self.block_left = 0
        self.end = bytearray()
        self.digest, self.size = hashlib.sha256(), 0
        self.parts: list[bytes] | None = [] if with_payload else None

    def feed(self, data: bytes) -> None:
        if self.header is None:
            self.head += data
            stop = self.head.find(b"\r\n\r\n")
            if stop < 0:
                return
            lines = self.head[:stop].decode().split("\r\n")
            self.header = {k: v for k, _, v in (line.partition(": ") for line in lines[1:])}
            if not lines[0].startswith("WARC/") or not self.header.get("Content-Length", "").isdigit():
                raise DamagedArchive("no WARC header")
            self.block_left = int(self.header["Content-Length"])
            data = bytes(self.head[stop + 4 :])
        block, rest = data[: self.block_left], data[self.block_left :]
        self.block_left -= len(block)
        self.end += rest
        if not self.in_payload:
            self.http += block
            stop = self.http.find(b"\r\n\r\n")
            if stop < 0:
                return
            self.in_payload, block = True, bytes(self.http[stop + 4 :])
        self.digest.update(block)
        self.size += len(block)
        if self.parts is not None:
            self.parts.append(block)

    def finished(self) -> Record:
        if self.header is None or self.block_left or self.end != b"\r\n\r\n":
            raise DamagedArchive("a record does not end where its length says")
        declared = self.header["WARC-Payload-Digest"].removeprefix("sha256:")
        if self.header["WARC-Type"] == "response" and declared != self.digest.hexdigest():
            raise DamagedArchive(f"payload of {self.header['WARC-Record-ID']} differs from its digest")
        payload = None if self.parts is None else b"".join(self.parts)
        return Record(self.header, self.size, declared, payload)


def read_records(stream, with_payload: bool = False) -> Iterator[Record]:
    """The records of one archive, in order, from anything with `read(n)`."""
    held = b""
    while held := held or stream.read(READ_BYTES):
        member, parser = zlib.decompressobj(GZIP), _RecordParser(with_payload)
        while not member.eof:
            held = held or stream.read(READ_BYTES)
            if not held:
                raise DamagedArchive("the archive ends within a record")
            try:
                parser.feed(member.decompress(held, READ_BYTES))
            except zlib.error as error:
                raise DamagedArchive(str(error)) from error
            held = member.unused_data if member.eof else member.unconsumed_tail
        yield parser.finished()


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all executors reach."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def with_revisits(
    pages: DataFrame, id_column: str, url_column: str, html_column: str, min_revisit_bytes: int
) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null for responses)."""
    rows = pages.select(
        F.col(quoted(id_column)).cast("long").alias("page_id"),
        F.col(quoted(url_column)).alias("url"),
        F.coalesce(F.col(quoted(html_column)).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    long_enough = staged(rows.filter(F.length("payload") >= min_revisit_bytes).select("page_id", "digest"))
    first = staged(
        long_enough.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1 and refers_to is not null")
        .drop("copies")
    )
    revisits = (
        long_enough.join(first, "digest")
        .filter("page_id is null or page_id > refers_to")
        .distinct()
        .select(F.col("page_id").alias("revisit_id"), F.col("digest").alias("revisit_digest"), "refers_to")
    )
    same = F.col("page_id").eqNullSafe(F.col("revisit_id")) & (F.col("digest") == F.col("revisit_digest"))
    return rows.join(revisits, same, "left").select("page_id", "url", "payload", "digest", "refers_to")


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    min_revisit_bytes: int = 100,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write archives into the folder; the manifest: path, n_records and n_bytes of each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = opened(folder)
        target.create_dir(base, recursive=True)
        name, records, size, stream = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                stream = stream or target.open_output_stream(name, compression=None)
                member = record_bytes(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"], date)
                stream.write(member)
                records, size = records + 1, size + len(member)
        if stream:
            stream.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "n_records": [records], "n_bytes": [size]})

    rows = with_revisits(pages, id_column, url_column, html_column, min_revisit_bytes)
    return staged(arrow_map(rows, write, "path string, n_records long, n_bytes long"))


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """All records of the archives, as RECORDS and, if asked for, payload (null for revisits)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, _ = opened(folder)
        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, held, seen = [], 0, 0
                with source.open_input_stream(path, compression=None) as stream:
                    for record in read_records(stream, with_payload):
                        rows.append(_row(record, with_payload))
                        held, seen = held + (record.payload_bytes if with_payload else 0), seen + 1
                        if len(rows) == 10_000 or held > READ_BYTES * 64:
                            yield _batch(rows, with_payload)
                            rows, held = [], 0
                if seen != expected:
                    raise DamagedArchive(f"{path} holds {seen} records instead of {expected}")
                yield _batch(rows, with_payload)

    files = manifest.select("path", "n_records")
    schema = RECORDS + (", payload binary" if with_payload else "")
    return arrow_map(files.repartition(max(1, files.count())), read, schema)


def _row(record: Record, with_payload: bool) -> tuple:
    def number(field: str) -> int | None:
        value = record.header.get(field, "").removeprefix("<urn:page:").removesuffix(">")
        return int(value) if value else None

    kind = record.header["WARC-Type"]
    row = (
        number("WARC-Record-ID"),
        record.header["WARC-Target-URI"],
        record.payload_bytes if kind == "response" else None,
        record.payload_digest,
        kind,
        number("WARC-Refers-To"),
    )
    return (*row, record.payload if kind == "response" else None) if with_payload else row


def _batch(rows: list[tuple], with_payload: bool) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    types += [pa.binary()] if with_payload else []
    names = [part.split()[0] for part in RECORDS.split(", ")] + (["payload"] if with_payload else [])
    columns = list(zip(*rows)) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def resolved(records: DataFrame) -> DataFrame:
    """Records without payload, where revisits have the size of the response they refer to.

    A revisit whose response is missing, or has another digest, is an error.
    """
    rows = staged(records.select(*[part.split()[0] for part in RECORDS.split(", ")]))
    responses = staged(
        rows.filter("record_type = 'response'")
        .groupBy(F.col("page_id").alias("response_id"), F.col("payload_digest").alias("response_digest"))
        .agg(F.max("payload_bytes").alias("response_bytes"))
    )
    same = (F.col("refers_to") == F.col("response_id")) & (F.col("payload_digest") == F.col("response_digest"))
    found = (
        rows.filter("record_type = 'revisit'")
        .join(responses, same, "left")
        .withColumn(
            "payload_bytes",
            F.coalesce("response_bytes", F.raise_error(F.lit("a revisit refers to no response")).cast("long")),
        )
    )
    return rows.filter("record_type = 'response'").unionByName(found.select(rows.columns))


def archived(pages: DataFrame, **options) -> DataFrame:
    """Write the pages to archives in the shared scratch folder and read them back."""
    folder = scratch_dir(pages.sparkSession)
    return resolved(read_archives(write_archives(pages, folder, **options), folder))
