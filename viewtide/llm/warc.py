"""WARC archives: writing pages as records, and reading archives record by record.

`write` puts every page into one record, each record into a gzip member of its own, and the
records of a task into archives of bounded size in a folder all executors share. Of the
pages with one payload that with the smallest id becomes a `response`; the others become
`revisit` records that refer to it and carry no payload. `read` streams archives, one task
per archive: it inflates a member piece by piece, frames the record by its Content-Length
and verifies block and payload digests, holding one record at a time.

Archives get new names in each attempt, and only those named in the written manifest count,
so a task that runs twice leaves nothing behind that is read. Files go through pyarrow's
file systems, so local, S3, GCS and HDFS folders work where pyarrow has them.

Defined cases: a missing page is an empty payload. Payloads below `least_bytes` are all
responses. A page without an id never is the one referred to. Repeated rows with the
smallest id are all responses. A damaged archive raises `WarcError`, naming archive and
offset.
"""

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.llm.tables import store
from viewtide.sources.scratch import scratch_dir

ARCHIVE_BYTES = 32 << 20
PIECE_BYTES = 256 << 10
_CROWDED = 100_000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_DATE = "1970-01-01T00:00:00Z"
_MANIFEST = "archive string, n_records bigint"
_RECORD = (
    "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, "
    "payload_bytes bigint, payload binary"
)


class WarcError(ValueError):
    """An archive that cannot be read as it stands."""


def classify(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to, which is missing for responses."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url",
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).withColumn("content_key", F.unhex(F.sha2("payload", 256)))
    groups = rows.filter(F.octet_length("payload") >= least_bytes).groupBy("content_key").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n")
    ).filter("n > 1 and first_id is not null")
    # Payloads with very many pages: at most one per `_CROWDED` pages, so they are sent to
    # all tasks. Their pages then join under keys of their own, spread over all partitions.
    crowded = groups.filter(F.col("n") > _CROWDED).select("content_key", F.col("first_id").alias("crowded_id"))
    others = groups.filter(F.col("n") <= _CROWDED).select(F.col("content_key").alias("join_key"), "first_id")
    spread = F.when(F.col("crowded_id").isNull(), F.col("content_key")).otherwise(
        F.unhex(F.sha2(F.concat_ws("/", "page_id", "url"), 224))
    )
    joined = rows.join(F.broadcast(crowded), "content_key", "left").withColumn("join_key", spread).join(
        others, "join_key", "left"
    )
    first = F.coalesce("crowded_id", "first_id")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != first), first)
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write the archives below `folder`; one row per archive."""
    records = classify(pages, least_bytes)
    return store(records.mapInArrow(lambda batches: _write(batches, folder), _MANIFEST), "manifest")


def read(manifest: DataFrame) -> DataFrame:
    """The records of the archives. A revisit has no payload of its own."""
    tasks = min(max(1, manifest.count()), 100_000)
    return manifest.select("archive").repartition(tasks).mapInArrow(_read, _RECORD)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write all pages and read them back: one row per page."""
    folder = posixpath.join(scratch_dir(pages.sparkSession), "warc")
    records = read(write(pages, folder, least_bytes))
    number = lambda column: F.regexp_extract(column, r"^<urn:page:(-?\d+)", 1).try_cast("bigint")
    return records.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"),
    )


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}:{uuid.uuid4().hex}>"),
        ("WARC-Date", _DATE),
        *([("WARC-Target-URI", " ".join(url.split()))] if url else []),
        ("WARC-Payload-Digest", f"sha1:{_digest(payload)}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    block = _HTTP.format(len(payload)).encode()
    if refers_to is None:
        block += payload
    else:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("WARC-Block-Digest", f"sha1:{_digest(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    disk, base = fs.FileSystem.from_uri(folder)
    disk.create_dir(base, recursive=True)
    out, name, size, n, written = None, "", 0, 0, []
    for batch in batches:
        for page_id, url, payload, refers_to in zip(*[c.to_pylist() for c in batch.columns]):
            if out is None:
                name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                out = disk.open_output_stream(posixpath.join(base, name), compression=None)
            member = record(page_id, url, payload, refers_to)
            out.write(member)
            size, n = size + len(member), n + 1
            if size >= ARCHIVE_BYTES:
                out.close()
                out = None
                written.append((name, n))
    if out is not None:
        out.close()
        written.append((name, n))
    yield pa.RecordBatch.from_pydict({
        "archive": pa.array([posixpath.join(folder, name) for name, _ in written], pa.string()),
        "n_records": pa.array([n for _, n in written], pa.int64()),
    })


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
        ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
    ])
    for batch in batches:
        for archive in batch.column(0).to_pylist():
            disk, path = fs.FileSystem.from_uri(archive)
            held, size = [], 0
            with disk.open_input_stream(path, compression=None) as stream:
                for found in records(stream, archive):
                    held.append(found)
                    size += len(found["payload"] or b"")
                    if size >= 4 << 20 or len(held) >= 2000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)


def members(stream, archive: str) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of every gzip member, inflated piece by piece."""
    offset, at = 0, 0
    unpacker, parts = None, []
    piece = stream.read(PIECE_BYTES)
    while piece:
        unpacker = unpacker or zlib.decompressobj(31)
        try:
            parts.append(unpacker.decompress(piece))
        except zlib.error as error:
            raise WarcError(f"{archive} at {offset}: {error}") from None
        at += len(piece) - len(unpacker.unused_data)
        piece = unpacker.unused_data
        if unpacker.eof:
            yield offset, b"".join(parts)
            unpacker, parts, offset = None, [], at
        piece = piece or stream.read(PIECE_BYTES)
    if unpacker:
        raise WarcError(f"{archive} at {offset}: it ends within a record")


def records(stream, archive: str) -> Iterator[dict]:
    for offset, content in members(stream, archive):
        try:
            yield parse(content)
        except WarcError as error:
            raise WarcError(f"{archive} at {offset}: {error}") from None


def parse(content: bytes) -> dict:
    """One record, framed by its Content-Length, digests verified."""
    head, gap, rest = content.partition(b"\r\n\r\n")
    lines = head.decode(errors="replace").split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise WarcError("no WARC header")
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
    try:
        length = int(fields["content-length"])
    except (KeyError, ValueError):
        raise WarcError("no Content-Length") from None
    block, tail = rest[:length], rest[length:]
    if len(block) != length or tail != b"\r\n\r\n":
        raise WarcError("Content-Length does not frame the record")
    _verify(fields, "warc-block-digest", block)
    kind = fields.get("warc-type", "")
    payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2] if "http" in fields.get("content-type", "") else block
        _verify(fields, "warc-payload-digest", payload)
    size = len(payload) if payload is not None else int(fields.get("x-payload-length", length))
    return {
        "record_id": fields.get("warc-record-id"), "record_type": kind,
        "target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"),
        "payload_digest": fields.get("warc-payload-digest", "").rpartition(":")[2] or None,
        "payload_bytes": size, "payload": payload,
    }


def _verify(fields: dict[str, str], name: str, data: bytes) -> None:
    stated = fields.get(name, "")
    if stated.startswith("sha1:") and stated[5:] != _digest(data):
        raise WarcError(f"{name} does not match")
