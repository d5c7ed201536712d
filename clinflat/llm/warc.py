"""WARC archives as tables of chunks.

A record is a row for each chunk of its bytes, (archive, record, chunk, data), so that a payload
of any size is written and read without holding it whole. Each row carries the digest of the
payload up to its end. The data of an archive in order of record and chunk are the bytes of a
WARC/1.1 file; write_files() lays them out as such.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflat.llm.common import checkpointed, in_small_batches, shared_folder, text_of

CHUNK_BYTES = 1 << 20
ROW = "archive long, record long, chunk long, last boolean, data binary, payload_sha1 binary"
ORDER = ["archive", "record", "chunk"]


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _one_line(value: str | None) -> str:
    return re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", value or "")


def _head(kind: str, page_id: str, refers_to: str | None, url: str | None, digest: str, size: int, date: str) -> bytes:
    """Header of a record and the HTTP header before its payload; a revisit keeps the latter."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Target-URI: {_one_line(url)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    lines.append(f"Content-Length: {len(http) + (0 if kind == 'revisit' else size)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def _payload(column: pa.StringArray, k: int) -> memoryview:
    """Bytes of a text in its Arrow buffer, without a copy."""
    if not column[k].is_valid:
        return memoryview(b"")
    return memoryview(column[k].as_buffer())


def records(
    pages: DataFrame,
    id_col: str = "page_id",
    payload_col: str = "html",
    url_col: str = "url",
    min_revisit_bytes: int = 0,
    chunk_bytes: int = CHUNK_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Chunk rows of one record per page.

    The payload is a text in UTF-8, null as empty. Of the pages with equal payloads of at least
    min_revisit_bytes, that with the largest id is a response and the others revisit it; smaller
    payloads are all responses. Pages that repeat the largest id are all responses, and so are
    pages without an id whose payload no page with an id has; others without an id revisit.
    Other columns are ignored.

    A page joins the row of its payload's digest; a payload that many pages share is
    pre-aggregated there, and Spark can split the join.
    """
    named = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), text_of(payload_col).alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    groups = checkpointed(named.groupBy("digest").agg(F.max("page_id").alias("first")))
    small = F.octet_length("payload") < min_revisit_bytes
    typed = named.join(groups, "digest").select(
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        F.when(~small & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first").cast("string")).alias("refers_to"),
        "payload",
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, record = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        waiting = 0
        for batch in batches:
            ids, urls, refers, payloads = batch.columns
            for k in range(batch.num_rows):
                payload = _payload(payloads, k)
                whole = hashlib.sha1()
                for a in range(0, len(payload), chunk_bytes):
                    whole.update(payload[a : a + chunk_bytes])
                refers_to = refers[k].as_py()
                kind = "revisit" if refers_to is not None else "response"
                head = _head(
                    kind, str(ids[k].as_py()), refers_to, urls[k].as_py(), _base32(whole.digest()), len(payload), date
                )
                body = payload[:0] if kind == "revisit" else payload
                digest = hashlib.sha1()
                n = max(1, -(-len(body) // chunk_bytes))
                for c in range(n):
                    part = body[c * chunk_bytes : (c + 1) * chunk_bytes]
                    digest.update(part)
                    data = b"".join([head if not c else b"", part, b"\r\n\r\n" if c == n - 1 else b""])
                    held.append((archive, record, c, c == n - 1, data, digest.digest()))
                    waiting += len(data)
                    if waiting >= 8 * chunk_bytes:
                        yield _batch(held)
                        held, waiting = [], 0
                record += 1
        yield _batch(held)

    in_small_batches(pages.sparkSession, 64)
    return typed.mapInArrow(rows, ROW)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["archive", "record", "chunk", "last", "data", "payload_sha1"])


class _Reader:
    """Reads the chunks of one record in order, keeping the running digest and length alone."""

    def __init__(self, first: memoryview) -> None:
        # headers are in the first chunk whole
        content = bytes(first)
        end = content.index(b"\r\n\r\n") + 4
        lines = content[:end].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:] if line)
        self.kind = fields["WARC-Type"]
        self.page_id = fields["WARC-Record-ID"][len("<urn:page:") : -1]
        refers = fields.get("WARC-Refers-To")
        self.refers_to = refers and refers[len("<urn:page:") : -1]
        self.digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        http_end = content.index(b"\r\n\r\n", end) + 4
        self.size = int(re.search(rb"Content-Length: (\d+)", content[end:http_end])[1])
        self.left = int(fields["Content-Length"]) - (http_end - end)
        self.seen, self.sha1 = 0, hashlib.sha1()
        self.add(first[http_end:])

    def add(self, data: memoryview) -> None:
        part = data[: self.left]
        self.sha1.update(part)
        self.seen, self.left = self.seen + len(part), self.left - len(part)

    def row(self, carried: bytes) -> tuple:
        digest = self.sha1.digest()
        if self.left or digest != carried:
            raise ValueError(f"record of page {self.page_id} is damaged")
        if self.kind == "revisit":
            return self.page_id, self.size, self.digest, self.kind, self.refers_to
        return self.page_id, self.seen, _base32(digest), self.kind, None


def read_records(chunks: DataFrame) -> DataFrame:
    """Per record page_id, payload_bytes, payload_digest, record_type, refers_to, ids as text.

    Length and digest of a response come from its bytes, those of a revisit from its headers. A
    record of one row is read where it lies; the rows of longer ones are brought together in
    order and read one by one. A record with a missing or changed chunk is an error; no rows
    give no records.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, place = None, None
        for batch in batches:
            found = []
            archive, record, chunk, last, data, digest = batch.columns
            for k in range(batch.num_rows):
                number, at = chunk[k].as_py(), (archive[k].as_py(), record[k].as_py())
                content = memoryview(data[k].as_buffer())
                if number == 0:
                    reader = _Reader(content)
                elif place != (*at, number - 1):
                    raise ValueError(f"a chunk is missing before chunk {number} of record {at}")
                else:
                    reader.add(content)
                place = (*at, number)
                if last[k].as_py():
                    found.append(reader.row(digest[k].as_py()))
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)], names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    in_small_batches(chunks.sparkSession, 64)
    short = (F.col("chunk") == 0) & F.col("last")
    one = chunks.where(short)
    long = chunks.where(~short).repartition("archive", "record").sortWithinPartitions(*ORDER)
    return one.mapInArrow(rows, schema).unionByName(long.mapInArrow(rows, schema))


def write_archive(pages: DataFrame, path: str, **options) -> None:
    """Write the chunk table of pages at path; options as for records()."""
    records(pages, **options).write.parquet(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return read_records(spark.read.schema(ROW).parquet(path))


def write_files(spark: SparkSession, path: str, folder: str) -> None:
    """Lay the chunk table at path out as files archive-N.warc in folder, chunk by chunk.

    folder is a location that pyarrow's file systems open from every executor.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        name, out = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                if batch.column(0)[k].as_py() != name:
                    if out:
                        out.close()
                    name = batch.column(0)[k].as_py()
                    out = store.open_output_stream(f"{root}/archive-{name:06d}.warc")
                out.write(batch.column(1)[k].as_buffer())
        if out:
            out.close()
        yield from ()

    chunks = spark.read.schema(ROW).parquet(path)
    ordered = chunks.repartition("archive").sortWithinPartitions(*ORDER).select("archive", "data")
    ordered.mapInArrow(write, "archive long").collect()  # no rows: the files are the result


def new_archive(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"


SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
), d AS (
  SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS hex, first FROM p
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, (5 * (k // 4) + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
