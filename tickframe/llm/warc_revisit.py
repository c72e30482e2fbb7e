"""WARC archives without repeated payloads: revisit records refer to the one response that holds the payload.

Only headers (page id, digest, length) are shuffled by payload digest.  The
smallest page id of each digest is a partial aggregate, so a payload that a third
of all pages share costs its task one row per upstream task.  The decision then
meets the page by page id and digest, and each task writes archives of gzip
members, one per record.

Reading parses the archives as streams, checks every stored payload against its
digest, and joins revisit records to the responses they refer to.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.llm._common import appending, byte_texts, written
from tickframe.llm._files import located, qualified

MIN_REVISIT_BYTES = 0
MAX_FILE_BYTES = 1_000_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_DIGEST = [T.StructField("payload_digest", T.StringType()), T.StructField("payload_bytes", T.LongType())]
_UNSAFE = re.compile(rb"[\x00-\x20\x7f-\xff]")
_RECORD = "page_id bigint, record_type string, record_id string, refers_to_id string, payload_digest string, payload_bytes bigint"


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, copy: int, digest: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{copy}:{digest}").urn


def _with_digest(pages: DataFrame) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        for batch in batches:
            texts = byte_texts(batch.column("html"))
            yield batch, [pa.array(list(map(payload_digest, texts)), pa.string()), pa.array(list(map(len, texts)), pa.int64())]

    return appending(pages, _DIGEST, compute)


def revisits(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, html) with payload_digest, payload_bytes, copy, original and record_type.

    Of equal payloads of at least ``min_revisit_bytes`` that with the smallest page_id is the response.  Rows of equal
    page_id and payload are numbered (copy, in the order of their url): only copy 1 can be the response.  A null html is
    empty; a null page_id comes after all others.
    """
    # one key without nulls for the join and the numbering of copies, so that payloads are shuffled once
    key = F.coalesce("page_id", F.lit(-(2**63)))
    known = _with_digest(pages.select("page_id", "url", "html")).withColumn("page_key", key)
    headers = known.select("page_id", "page_key", "payload_digest")
    originals = headers.groupBy("payload_digest").agg(F.min("page_id").alias("original"))
    decided = headers.select("page_key", "payload_digest").distinct().join(originals, "payload_digest")
    joined = known.join(decided, ["page_key", "payload_digest"])
    copy = F.row_number().over(W.partitionBy("page_key", "payload_digest").orderBy("url"))
    again = ~F.col("page_id").eqNullSafe(F.col("original")) | (F.col("copy") > 1)
    kind = F.when(again & (F.col("payload_bytes") >= min_revisit_bytes), "revisit").otherwise("response")
    return (joined.withColumn("copy", copy).withColumn("record_type", kind)
            .select("page_id", "url", "html", "payload_digest", "payload_bytes", "copy", "original", "record_type"))


def _record(page: dict, payload: bytes, date: str) -> bytes:
    digest = page["payload_digest"]
    target = page["url"].encode() if page["url"] else f"urn:x-page:{page['page_id']}".encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = page["record_type"] == "revisit"
    block = http if revisit else http + payload
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + page["record_type"].encode(),
        b"WARC-Record-ID: <" + record_id(page["page_id"], page["copy"], digest).encode() + b">",
        b"WARC-Date: " + date.encode(),
        b"WARC-Target-URI: " + _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], target),
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
        b"WARC-Block-Digest: sha1:" + payload_digest(block).encode(),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    if page["page_id"] is not None:
        head.append(b"X-Page-Id: %d" % page["page_id"])
    if revisit:
        head += [b"WARC-Profile: " + PROFILE.encode(),
                 b"WARC-Refers-To: <" + record_id(page["original"], 1, digest).encode() + b">"]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES,
                   date: datetime | None = None, max_file_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Writes a record per row of ``pages`` as .warc.gz files to the folder ``path``; returns the manifest (name, records, bytes).

    Only files in the manifest (``path/manifest``) count: each attempt of a task writes under new names.
    """
    stamp = (date or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    path = qualified(pages.sparkSession, path)
    system, folder = located(path)
    system.create_dir(folder, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = located(path)
        out, name, records, size = None, "", 0, 0
        names = ("page_id", "url", "payload_digest", "copy", "original", "record_type")
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in names]
            for payload, *values in zip(byte_texts(batch.column("html")), *columns, strict=True):
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{folder}/{name}", compression=None)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(_record(dict(zip(names, values, strict=True)), payload, stamp)) + packer.flush()
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= max_file_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"name": [name], "records": [records], "bytes": [size]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"name": [name], "records": [records], "bytes": [size]})

    (revisits(pages, min_revisit_bytes).mapInArrow(run, "name string, records bigint, bytes bigint")
     .write.parquet(f"{path}/manifest"))
    return pages.sparkSession.read.parquet(f"{path}/manifest")


def _parsed(stream: gzip.GzipFile) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError("a WARC record ends early")
        yield fields, block


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row per record in the archives of ``path``, with the payload (binary, null for revisits) if asked for.

    A response whose payload doesn't have its digest is an error.
    """
    schema = _RECORD + (", payload binary" if payloads else "")
    path = qualified(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = located(path)
        names = [n.split()[0] for n in schema.split(", ")]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)], names)

        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, size = [], 0
                with system.open_input_stream(f"{folder}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for fields, block in _parsed(stream):
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        response = fields["warc-type"] == "response"
                        payload = block[block.index(b"\r\n\r\n") + 4:] if response else None
                        if response and payload_digest(payload) != digest:
                            raise ValueError(f"{name}: payload of {fields['warc-record-id']} doesn't have its digest")
                        page, refers = fields.get("x-page-id"), fields.get("warc-refers-to")
                        row = (int(page) if page else None, fields["warc-type"], fields["warc-record-id"][1:-1],
                               refers[1:-1] if refers else None, digest, len(payload) if response else None)
                        rows.append((*row, payload) if payloads else row)
                        size += len(payload or b"") if payloads else 200
                        if size > 16_000_000:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.parquet(f"{path}/manifest").select("name")
    return files.repartition(max(1, files.count()), "name").mapInArrow(run, schema)  # a task per file or so


def resolved(records: DataFrame) -> DataFrame:
    """``records`` with refers_to (the response's page_id) and payload_bytes also for revisits.

    A revisit whose response is missing keeps nulls there.
    """
    records = written(records, "warc-records")
    responses = records.where("record_type = 'response'").select(
        F.col("record_id").alias("r"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("b"))
    again = (records.where("record_type = 'revisit'").join(responses, F.col("refers_to_id") == F.col("r"), "left")
             .withColumn("payload_bytes", F.col("b")).drop("r", "b"))
    first = records.where("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("bigint"))
    return first.unionByName(again)
