"""Web archives packaged in ZIP files, written per partition and read by ranges.

A package holds one stored member ``archive/data.warc.gz`` (one gzip member per
WARC record) and one stored member ``indexes/index.jsonl`` with the place of
every record. The reader takes the end-of-central-directory record, ZIP64 if
there is one, from the tail of the file, the central directory, and the index;
then it reads each record by its range. Nothing is extracted.

Packages go to the cluster's shared folder through Arrow's file systems. Their
names are unique for each attempt and only the written manifest of finished
tasks is read, so a task that runs again leaves no double records.

Defined cases: null html is an empty payload; a null url is left out and read as
null; a null ``page_id`` is kept, it is never the smallest of a group that has
another id, and a group of null ids alone is all responses; rows that repeat the
smallest id of a group are responses as well; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import gzip
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from georisk.workspace import new_path, settle

LEAST_BYTES = 100
PACKAGE_BYTES, MOST_PARTS = 24 << 20, 50_000
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
BATCH = 500
# Fixed values of the WARC and ZIP formats.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
ZIP64_EXTRA, MAX16, MAX32 = 1, 0xFFFF, 0xFFFFFFFF

MANIFEST_SCHEMA = "path string, records long, bytes long"
RECORD_SCHEMA = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


# --- WARC records

def one_line(value: str) -> str:
    """Header values hold no line breaks; control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or c == "%" else c for c in value)


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to: int | None) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    name = "" if page_id is None else page_id
    headers = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        headers.append(f"WARC-Target-URI: {one_line(url)}")
    if revisit:
        headers += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    headers += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(raw: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in raw.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _page(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def plain_url(value: str | None) -> str | None:
    from urllib.parse import unquote

    return None if value is None else unquote(value)


def parse_record(raw: bytes) -> tuple[tuple, bytes | None]:
    """(row of RECORD_SCHEMA, payload or None); a payload is held against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("no WARC record here")
    fields = _fields(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(_fields(http)["content-length"])
    digest, kind = fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"]
    if kind == "response" and (len(payload) != size or sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
    row = (_page(fields["warc-record-id"]), plain_url(fields.get("warc-target-uri")), size, digest, kind,
           _page(fields.get("warc-refers-to")))
    return row, payload if kind == "response" else None


# --- ZIP directories

class Member(NamedTuple):
    name: str
    method: int
    size: int
    stored: int
    header: int


def read_end(file: pa.NativeFile) -> tuple[int, int, int]:
    """(entries, size, offset) of the central directory."""
    size = file.size()
    tail_size = min(size, MAX16 + 22)
    tail = file.read_at(tail_size, size - tail_size)
    at = tail.rfind(END)
    while at >= 0 and len(tail) - at - 22 != struct.unpack_from("<H", tail, at + 20)[0]:
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file")
    entries, length, offset = struct.unpack_from("<HII", tail, at + 10)
    locator = size - tail_size + at - 20
    if locator >= 0:
        raw = file.read_at(20, locator)
        if raw[:4] == LOCATOR64:
            place = struct.unpack_from("<Q", raw, 8)[0]
            record = file.read_at(56, place)
            if record[:4] != END64:
                raise ValueError("ZIP64 locator points nowhere")
            entries, length, offset = struct.unpack_from("<QQQ", record, 32)
    return entries, length, offset


def read_members(file: pa.NativeFile) -> list[Member]:
    """All entries of the central directory, with ZIP64 sizes and places where given."""
    entries, length, offset = read_end(file)
    raw, at, members = file.read_at(length, offset), 0, []
    for _ in range(entries):
        if raw[at:at + 4] != ENTRY:
            raise ValueError("damaged central directory")
        method, = struct.unpack_from("<H", raw, at + 10)
        stored, size, name_len, extra_len, comment_len = struct.unpack_from("<IIHHH", raw, at + 20)
        header, = struct.unpack_from("<I", raw, at + 42)
        name = raw[at + 46:at + 46 + name_len].decode()
        extra = raw[at + 46 + name_len:at + 46 + name_len + extra_len]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == ZIP64_EXTRA:
                # Only the fields that overflow are there, in this order.
                values = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                size = next(values) if size == MAX32 else size
                stored = next(values) if stored == MAX32 else stored
                header = next(values) if header == MAX32 else header
            extra = extra[4 + n:]
        members.append(Member(name, method, size, stored, header))
        at += 46 + name_len + extra_len + comment_len
    return members


def stored_place(file: pa.NativeFile, members: list[Member], name: str) -> tuple[int, int]:
    """(offset, length) of the bytes of a member that is stored and not compressed."""
    found = [m for m in members if m.name == name]
    if not found:
        raise ValueError(f"no member {name}")
    if found[0].method != zipfile.ZIP_STORED:
        raise ValueError(f"member {name} is compressed; its records can't be read by range")
    raw = file.read_at(30, found[0].header)
    if raw[:4] != LOCAL:
        raise ValueError(f"no local header of {name}")
    name_len, extra_len = struct.unpack_from("<HH", raw, 26)
    return found[0].header + 30 + name_len + extra_len, found[0].stored


# --- packages

class Sink:
    """What zipfile needs of a stream that can't seek."""

    def __init__(self, stream: pa.NativeFile):
        self.stream, self.place = stream, 0

    def write(self, data: bytes) -> int:
        self.stream.write(data)
        self.place += len(data)
        return len(data)

    def tell(self) -> int:
        return self.place

    def flush(self) -> None:
        pass


class Package:
    """One ZIP package being written."""

    def __init__(self, folder: str):
        self.path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.zip"
        system, place = pafs.FileSystem.from_uri(self.path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.stream = system.open_output_stream(place)
        self.sink = Sink(self.stream)
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.index: list[str] = []
        self.size = 0

    def add(self, page_id: int | None, record: bytes) -> None:
        data = gzip.compress(record, compresslevel=1, mtime=0)
        self.member.write(data)
        self.index.append(json.dumps({"page_id": page_id, "offset": self.size, "length": len(data)}))
        self.size += len(data)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.index))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.index), self.sink.place


def read_package(path: str) -> Iterator[tuple[tuple, bytes | None]]:
    """Rows and payloads of all records of a package, each read by its range."""
    system, place = pafs.FileSystem.from_uri(path)
    with system.open_input_file(place) as file:
        members = read_members(file)
        start, length = stored_place(file, members, INDEX)
        index = file.read_at(length, start).decode()
        base, size = stored_place(file, members, ARCHIVE)
        for line in index.split("\n") if index else []:
            entry = json.loads(line)
            if entry["offset"] + entry["length"] > size:
                raise ValueError("index points beyond the archive")
            raw = zlib.decompress(file.read_at(entry["length"], base + entry["offset"]), 31)
            yield parse_record(raw)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record for each page to packages in ``folder``; returns the manifest.

    Of records with equal payloads of at least LEAST_BYTES the one with the
    smallest ``page_id`` is the response, the others revisit it.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256)).withColumn("size", F.octet_length("html"))
    firsts = rows.where(F.col("size") >= LEAST_BYTES).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    marked = rows.join(firsts.select("digest", "first"), "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                package = package or Package(folder)
                package.add(page_id, warc_record(
                    page_id, url, html.encode(), digest, refers_to is not None, refers_to))
                if package.size >= PACKAGE_BYTES:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        paths, records, sizes = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
            names=["path", "records", "bytes"])

    return settle(marked.mapInArrow(run, MANIFEST_SCHEMA), "manifest")


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record of the packages that ``manifest`` names, with ``payload`` on request."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]

        def out(rows: list[tuple], bodies: list[bytes | None]) -> pa.RecordBatch:
            columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            if payloads:
                columns.append(pa.array(bodies, pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=[*names, "payload"][:len(columns)])

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, bodies = [], []
                for row, body in read_package(path):
                    rows.append(row)
                    bodies.append(body if payloads else None)
                    if len(rows) >= BATCH:
                        yield out(rows, bodies)
                        rows, bodies = [], []
                if rows:
                    yield out(rows, bodies)

    # A row of the manifest stands for megabytes: the number of parts follows the packages.
    spread = manifest.select("path").repartition(max(1, min(manifest.count(), MOST_PARTS)), "path")
    return spread.mapInArrow(run, RECORD_SCHEMA + (", payload binary" if payloads else ""))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to packages in the shared folder and read back."""
    return read_archives(write_archives(pages, new_path(pages.sparkSession, "packages")))
