"""WARC archives: one gzip member per record, written by Spark tasks and
read back record by record.

``write_archives`` gives each page a record: a ``response`` with the page's
bytes, or, where an equal payload belongs to a page of smaller id, a
``revisit`` that refers to that page's record and holds the response's header
only. Every task writes archives of its own into the shared folder under a
fresh name; the manifest, committed by Spark, names the archives of the
attempts that counted, so a task that is run again leaves no double records.

``read_archives`` reads each archive from its start: gzip members are
inflated piece by piece as bytes arrive, a record's block is framed by its
``Content-Length``, and block and payload digests are verified. A broken
archive raises ``WarcError``; no record is passed over.

Defined results: a null html is an empty payload. A null id is larger than
all ids; its record has a random id and is read back with a null id. Rows
that repeat an id and a payload have the same type. Control characters and
spaces in a url are percent-encoded in the record. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import written
from corvid.session import scratch_path

# Payloads of fewer bytes are always responses.
MIN_REVISIT_BYTES = 0
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 1 << 16
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2026-01-01T00:00:00Z"


# Spark's names of file systems that Arrow names otherwise.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


class WarcError(ValueError):
    """An archive that is not well formed, or whose digests don't hold."""


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_uri(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _page_of(uri: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(found[1]) if found else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """One record, not compressed."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if is_revisit else head + payload
    fields = [("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", page_uri(page_id)),
              ("WARC-Date", RECORD_DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if is_revisit:
        fields += [("WARC-Refers-To", page_uri(refers_to)), ("WARC-Profile", PROFILE)]
    fields += [("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def open_folder(uri: str):
    """File system and path of a folder URI, as any task can reach it:
    file, s3 (also as Spark's s3a), gs, abfs or hdfs. Others are refused."""
    from pyarrow.fs import FileSystem

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    scheme, mark, rest = uri.partition("://")
    try:
        return FileSystem.from_uri(_SCHEMES.get(scheme, scheme) + mark + rest)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as e:
        raise ValueError(f"archives go to file, s3a, gs, abfs or hdfs folders, not to {uri}") from e


def members(stream, read_bytes: int = READ_BYTES):
    """The inflated bytes of each gzip member of a stream, in order."""
    unpacker, parts, pending = zlib.decompressobj(31), [], stream.read(read_bytes)
    started = False
    while pending:
        try:
            parts.append(unpacker.decompress(pending))
        except zlib.error as e:
            raise WarcError(f"bytes that don't inflate: {e}") from e
        started = True
        if unpacker.eof:
            yield b"".join(parts)
            pending, parts, started, unpacker = unpacker.unused_data, [], False, zlib.decompressobj(31)
            pending = pending or stream.read(read_bytes)
        else:
            pending = stream.read(read_bytes)
    if started:
        raise WarcError("the archive ends within a member")


@dataclass
class Record:
    fields: dict[str, str]
    block: bytes

    @property
    def type(self) -> str:
        return self.fields.get("warc-type", "")

    @property
    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2]

    @property
    def payload_bytes(self) -> int:
        """Bytes of the full payload, which a revisit's header states."""
        if self.type != "revisit":
            return len(self.payload)
        head = self.block.partition(b"\r\n\r\n")[0].decode("latin-1")
        found = re.search(r"(?im)^content-length:\s*(\d+)\s*$", head)
        if not found:
            raise WarcError("a revisit without its payload's length")
        return int(found[1])

    @property
    def payload_digest(self) -> str:
        return self.fields.get("warc-payload-digest", "").removeprefix("sha1:")


def parse_record(data: bytes) -> Record:
    """The one record of a member; digests that it states are verified."""
    head, split, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not split or not re.fullmatch(rb"WARC/\d+\.\d+", lines[0]):
        raise WarcError("a member that doesn't begin with a record's header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon:
            raise WarcError(f"a header line without a name: {line[:80]!r}")
        fields[name.strip().lower()] = value.strip()
    try:
        length = int(fields["content-length"])
    except (KeyError, ValueError) as e:
        raise WarcError("a record without a usable Content-Length") from e
    if rest[length:] != b"\r\n\r\n":
        raise WarcError("a record that its Content-Length doesn't frame")
    record = Record(fields, rest[:length])
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{base32_sha1(record.block)}":
        raise WarcError("a block whose digest doesn't hold")
    if record.type == "response" and "warc-payload-digest" in fields and record.payload_digest != base32_sha1(record.payload):
        raise WarcError("a payload whose digest doesn't hold")
    return record


def with_roles(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, refers_to, is_revisit`` of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    copies = written(rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha1").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").drop("n"), "copies")
    later = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(copies, "sha1", "left").select(
        "page_id", "url", "payload", F.when(later, F.col("first")).alias("refers_to"), later.alias("is_revisit"))


def write_archives(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all ``pages`` (``page_id``, ``url``, ``html``); returns the
    manifest: ``archive, records, bytes``."""
    folder = scratch_path(pages.sparkSession, "warc")
    open_folder(folder)                         # fails here, not in the tasks

    def write(batches):
        system, path = open_folder(folder)
        out, done = None, []

        def close():
            nonlocal out
            if out is not None:
                out.close()
                out = None

        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                page_id, url, payload, refers_to, is_revisit = (x.as_py() for x in row)
                if out is None or done[-1][2] >= archive_bytes:
                    close()
                    system.create_dir(path, recursive=True)
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                    done.append([f"{folder}/{name}", 0, 0])
                member = gzip_member(record_bytes(page_id, url, payload, refers_to, is_revisit))
                out.write(member)
                done[-1][1] += 1
                done[-1][2] += len(member)
        close()
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in
                                          enumerate((pa.string(), pa.int64(), pa.int64()))],
                                         names=["archive", "records", "bytes"])

    return written(with_roles(pages, min_bytes).mapInArrow(write, "archive string, records long, bytes long"), "manifest")


def read_archives(manifest: DataFrame, keep_payload: bool = True) -> DataFrame:
    """The records of all archives: ``page_id, url, record_type,
    payload_bytes, payload_digest, refers_to`` and, with ``keep_payload``,
    ``payload`` (null for revisits)."""
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * keep_payload

    def read(batches):
        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), kinds, strict=True)],
                                              names=[n for n, _ in kinds])

        for batch in batches:
            for archive in batch.column(0).to_pylist():
                system, path = open_folder(archive)
                rows, held = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for data in members(stream):
                        r = parse_record(data)
                        row = (_page_of(r.fields.get("warc-record-id")), r.fields.get("warc-target-uri"), r.type,
                               r.payload_bytes, r.payload_digest, _page_of(r.fields.get("warc-refers-to")))
                        if keep_payload:
                            row += (None if r.type == "revisit" else r.payload,)
                            held += len(r.payload)
                        rows.append(row)
                        if len(rows) >= 5000 or held >= 8 << 20:
                            yield packed(rows)
                            rows, held = [], 0
                if rows:
                    yield packed(rows)

    spec = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
            + ", payload binary" * keep_payload)
    # as many tasks as archives; a shuffle of so few rows would be coalesced
    # into one task if its number of partitions were left open
    archives = max(1, manifest.count())
    return manifest.select("archive").repartition(archives, "archive").mapInArrow(read, spec)
