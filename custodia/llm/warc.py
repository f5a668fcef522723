"""WARC archives: one gzip member per record, equal payloads stored once, read back sequentially.

``write`` finds equal payloads by digest with one small aggregate, then every
task writes its pages to archives of about ``archive_bytes``. ``read`` inflates
member after member in small steps, takes records by their content length and
verifies block and payload digests. A revisit record keeps the HTTP headers of
its page, so its payload length, and names the record that holds the payload.

Null or empty payloads are written as empty responses. Repeated page ids give
one record each; of equal payloads all records with the smallest id are
responses. A null page id is the largest. Null urls stay null.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.llm.common import pick
from custodia.llm.files import attempt_name, get, put, spread

ARCHIVE_BYTES = 16 << 20
STEP = 1 << 16
REVISIT_FROM = 100
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"

RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def plan(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Each page with its payload, digest and, where an earlier page has the same payload, that page's id."""
    pages = pick(pages, page_id=(id_col, "long"), url=(url_col, "string"), payload=(html_col, "binary"))
    pages = pages.withColumn("payload", F.coalesce("payload", F.lit(b""))).withColumn("digest", F.sha2("payload", 256))
    large = F.length("payload") >= REVISIT_FROM
    rank = F.coalesce("page_id", F.lit(2**63 - 1))
    shared = (
        pages.where(large)
        .groupBy(F.col("digest").alias("of"))
        .agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
        .where("first < last")
        .drop("last")
    )
    joined = pages.join(shared, large & (F.col("digest") == F.col("of")), "left")
    return joined.select("page_id", "url", "payload", "digest", F.when(rank > F.col("first"), F.col("first")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as one gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit")]
    head.append(("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}>"))
    head.append(("WARC-Date", EPOCH))
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~")))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    head.append(("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()))
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(text + block + b"\r\n\r\n") + squeeze.flush()


def write(spark: SparkSession, pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, **columns: str) -> DataFrame:
    """Write all pages to ``folder`` and return the list of archives, stored beside them: name, records, bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, number = [], 0, 0

        def close() -> pa.RecordBatch:
            name = attempt_name("pages", number) + ".warc.gz"
            put(f"{folder}/archives", name, b"".join(parts))
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [len(parts)], "bytes": [size]})

        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                parts.append(record(*(value.as_py() for value in row)))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield close()
                    parts, size, number = [], 0, number + 1
        if parts:
            yield close()

    listed = plan(pages, **columns).mapInArrow(run, "archive string, records long, bytes long")
    listed.write.parquet(f"{folder}/archive_list")
    return spark.read.parquet(f"{folder}/archive_list")


def members(archive: BinaryIO) -> Iterator[bytes]:
    """The content of each gzip member of a stream, inflated step by step."""
    rest = archive.read(STEP)
    while rest:
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if not rest:
                raise ValueError("archive ends inside a member")
            parts.append(inflate.decompress(rest))
            rest = inflate.unused_data or archive.read(STEP)
        yield b"".join(parts)


def parse(member: bytes) -> dict:
    """The page of one record; raises ValueError where lengths or digests do not agree."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields = dict(line.decode().split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("content length does not frame the record")
    if fields["WARC-Block-Digest"] != "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode():
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(http.rpartition(b"Content-Length: ")[2])
    digest, revisit = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != stated or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("payload digest or length differs")
    name, uri = fields["WARC-Record-ID"][10:-1], fields.get("WARC-Target-URI")
    return {
        "page_id": None if name == "none" else int(name),
        "url": None if uri is None else unquote(uri),
        "record_type": fields["WARC-Type"],
        "refers_to": int(fields["WARC-Refers-To"][10:-1]) if revisit else None,
        "payload_bytes": stated,
        "payload_digest": digest,
        "payload": None if revisit else payload,
    }


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the listed archives; a revisit has no payload of its own."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ])

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name in (x for given in batches for x in given.column(0).to_pylist()):
            rows, size = [], 0
            with get(f"{folder}/archives", name) as archive:
                for member in members(archive):
                    rows.append(parse(member))
                    if not payloads:
                        rows[-1]["payload"] = None
                    size += rows[-1]["payload_bytes"] if payloads else 64
                    if size >= STEP * 16:
                        yield batch(rows)
                        rows, size = [], 0
            if rows:
                yield batch(rows)

    return spread(spark.read.parquet(f"{folder}/archive_list").select("archive"), "archive").mapInArrow(run, RECORDS)
