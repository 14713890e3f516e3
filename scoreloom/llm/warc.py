"""WARC archives: a deterministic sharded writer, and a reader.

Writing. Records are range-sorted by (page, digest, address), so that a run over the same
rows gives the same files. A task streams its range into gzip members, one per record, and
rolls to a new file when the compressed size passes `roll_bytes`. Headers and digests are
made anew from the payload. Files are written under temporary names of this attempt and
renamed when complete; a task that runs twice renames equal bytes over each other. The
names of finished files go into a manifest, a Parquet table with Spark's own commit; what
the manifest does not name is not part of the archive, so leftovers of lost tasks do not count.

Deduplication. Of the records with equal payloads of at least `least_bytes` the one with the
largest page id is the response, the others revisit it and carry no payload. Only digests
and ids are grouped; the payload moves for the sort, and for the join only if copies are many.

Folders must be reachable by every executor through the storage layer of pyarrow.

Defined results: a null payload is the empty payload; a null page id is written as an empty
`X-Page-Id`, sorts first and is a response only where its group has no other id; of repeated rows
(equal id and payload) the first is the response and the others revisit it; a null url is the
empty target; the reader returns every record of the manifest; other columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import uuid
import zlib

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm import packed

ROLL_BYTES = 32 << 20
PARTITION_BYTES = 64 << 20
SLICE_BYTES = 8 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "file string, part int, number int, records long, bytes long, first_page long, last_page long, sha256 string"
_RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The storage of a folder named by address or absolute path."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line, reversibly."""
    return json.dumps(value)[1:-1] if any(c < " " or c in '\\\x7f\x85  ' for c in value) else value


def record_bytes(page, url, payload: bytes, payload_digest: str, size: int, refers_to, revisit: bool, copy: int, date: str) -> bytes:
    """One record, as a gzip member of its own."""
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page}/{payload_digest}/{copy}")
    headers = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {_clean(url or '')}", f"WARC-Payload-Digest: sha1:{payload_digest}",
        f"WARC-Block-Digest: sha1:{digest(payload)}", f"X-Page-Id: {'' if page is None else page}", f"X-Payload-Length: {size}",
        f"X-Escaped: {int(_clean(url or '') != (url or ''))}", f"X-No-URI: {int(url is None)}", "Content-Type: text/html; charset=utf-8",
    ]
    if revisit:
        headers += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page: {'' if refers_to is None else refers_to}"]
    headers.append(f"Content-Length: {len(payload)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = ("\r\n".join(headers) + "\r\n\r\n").encode()
    return packer.compress(head) + packer.compress(payload) + packer.compress(b"\r\n\r\n") + packer.flush()


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    headers = dict(line.split(": ", 1) if ": " in line else (line[:-1], "") for line in lines[1:])
    size = int(headers["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length does not fit its bytes")
    return headers, rest[:size]


class _Roller:
    """Writes members to files of bounded size; each file appears complete or not at all."""

    def __init__(self, folder: str, part: int, roll_bytes: int):
        self.storage, self.folder = open_folder(folder)
        self.part, self.roll_bytes, self.number, self.sink = part, roll_bytes, 0, None

    def write(self, member: bytes, page) -> dict | None:
        if self.sink is None:
            self.temporary = posixpath.join(self.folder, f"_tmp-{self.part:06d}-{self.number:04d}-{uuid.uuid4().hex}")
            self.sink = self.storage.open_output_stream(self.temporary)
            self.size, self.records, self.pages, self.hash = 0, 0, [], hashlib.sha256()
        self.sink.write(member)
        self.hash.update(member)
        self.size += len(member)
        self.records += 1
        self.pages = [self.pages[0] if self.pages else page, page]
        return self.close() if self.size >= self.roll_bytes else None

    def close(self) -> dict | None:
        if self.sink is None:
            return None
        self.sink.close()
        self.sink = None
        name = f"part-{self.part:06d}-{self.number:04d}.warc.gz"
        self.storage.move(self.temporary, posixpath.join(self.folder, name))
        self.number += 1
        return {
            "file": name, "part": self.part, "number": self.number - 1, "records": self.records, "bytes": self.size,
            "first_page": self.pages[0], "last_page": self.pages[1], "sha256": self.hash.hexdigest(),
        }


def _writer(folder: str, roll_bytes: int, date: str, least_bytes: int):
    def write(batches):
        roller, before, copy = _Roller(folder, TaskContext.get().partitionId(), roll_bytes), None, 0
        done = []
        sizes = lambda b: pc.binary_length(b.column("payload")).to_numpy(zero_copy_only=False).astype("int64")
        for rows in (x for b in batches for x in packed.slices(b, sizes(b), SLICE_BYTES)):
            for page, url, payload, sha, refers_to in zip(*[rows.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")]):
                payload = payload or b""
                text = base64.b32encode(sha).decode()
                copy = copy + 1 if before == (page, sha) else 0
                before = (page, sha)
                revisit = len(payload) >= least_bytes and (refers_to != page or copy > 0)
                size = len(payload)
                member = record_bytes(page, url, b"" if revisit else payload, text, size, refers_to, revisit, copy, date)
                done.append(roller.write(member, page))
        done.append(roller.close())
        rows = [x for x in done if x]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("file", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("records", pa.int64()), ("bytes", pa.int64()),
            ("first_page", pa.int64()), ("last_page", pa.int64()), ("sha256", pa.string()),
        ]))

    return write


def write_archive(
    pages: DataFrame, folder: str, least_bytes: int = 0, roll_bytes: int = ROLL_BYTES, date: str = DATE,
    id_column: str = "page_id", url: str = "url", payload: str = "html",
) -> DataFrame:
    """Writes all rows below `folder` and returns the manifest. The folder must be new."""
    storage, path = open_folder(folder)
    storage.create_dir(posixpath.join(path, "data"), recursive=True)
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary")).alias("payload"),
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    # The largest id of each payload that stands more than once. Its stored size decides
    # whether the join ships it to the rows or shuffles them.
    winners = rows.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    winners = packed.staged(winners.where("n > 1").select("digest", "refers_to"), posixpath.join(folder, "copies"))
    size, n = rows.agg(F.sum(F.octet_length("payload")).cast("long"), F.count("*")).first()
    told = rows.join(winners, "digest", "left").withColumn("refers_to", F.coalesce("refers_to", "page_id"))
    ordered = told.repartitionByRange(max(12, -(-(size or 0) // PARTITION_BYTES)), "page_id", "digest", "url")
    ordered = ordered.sortWithinPartitions("page_id", "digest", "url").select("page_id", "url", "payload", "digest", "refers_to")
    written = ordered.mapInArrow(_writer(posixpath.join(folder, "data"), roll_bytes, date, least_bytes), _MANIFEST)
    return packed.staged(written, posixpath.join(folder, "manifest"))


def _members(stream, size: int = 1 << 20):
    """The unpacked gzip members of a stream, one at a time."""
    unpack, parts, data = zlib.decompressobj(31), [], b""
    while data or (data := stream.read(size)):
        parts.append(unpack.decompress(data))
        data = b""
        if unpack.eof:
            data = unpack.unused_data
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []
    if parts and any(parts):
        raise ValueError("the file ends inside a record")


def _reader(folder: str, payloads: bool):
    number = lambda x: int(x) if x else None

    def read(batches):
        storage, path = open_folder(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, held = [], 0
                with storage.open_input_stream(posixpath.join(path, name), compression=None) as stream:
                    for member in _members(stream):
                        headers, payload = parse_record(member)
                        uri = headers["WARC-Target-URI"]
                        uri = json.loads(f'"{uri}"') if headers["X-Escaped"] == "1" else uri
                        if headers["WARC-Type"] == "response" and f"sha1:{digest(payload)}" != headers["WARC-Payload-Digest"]:
                            raise ValueError(f"{name}: a payload does not have its digest")
                        rows.append({
                            "page_id": number(headers["X-Page-Id"]), "url": None if headers["X-No-URI"] == "1" else uri,
                            "record_type": headers["WARC-Type"], "refers_to": number(headers.get("X-Refers-To-Page", "")),
                            "payload_bytes": int(headers["X-Payload-Length"]), "payload_digest": headers["WARC-Payload-Digest"][5:],
                            "payload": payload if payloads else None,
                        })
                        held += len(payload)
                        if held > 4 << 20 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return read


_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])


def read_archive(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Every record that the manifest of `folder` names; revisits have an empty payload."""
    manifest = spark.read.parquet(posixpath.join(folder, "manifest"))
    files = manifest.select("file", "bytes")
    n = max(12, files.count() // 4)
    return files.repartition(n, "file").mapInArrow(_reader(posixpath.join(folder, "data"), payloads), _RECORDS)
