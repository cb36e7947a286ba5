"""WARC records in ZIP packages: writer, and a reader that never extracts.

Writing: each task packs its pages into ZIP files below the shared folder. A package holds two stored
(uncompressed) members: ``archive/data.warc.gz``, one gzip member per record, and
``indexes/index.cdx``, a line per record with its offset and length in the archive. Names are unique per
attempt and only the manifest of successful tasks is read, so a lost executor leaves no trace.

Reading: the end-of-central-directory record (or its ZIP64 form) gives the central directory, which gives
the members; the local header gives where a member's bytes begin. Each record is read by its range and
unpacked alone; its digest is verified.

Equal payloads: the digests are grouped before any payload moves, and only digests that occur more than
once are joined back (an ordinary join that can be split when a payload is very frequent). Rows of the
smallest page_id of a payload are responses, the others revisits that refer to it.

Defined results: a null html is an empty payload; a null page_id sorts last and is a revisit if
another page has the payload; repeated rows of the smallest page_id are responses all; payloads below
``min_bytes`` are responses; a null url has no target URI; line breaks in a url are percent-encoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import binary_list, materialise, shared_dir

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
# Signatures of the ZIP format.
EOCD, EOCD64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
SCHEMA = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def record_id(page_id: str | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(value: str) -> str | None:
    return value[len("<urn:page:"):-1] or None


def warc_record(page_id: str | None, url: bytes | None, payload: bytes, digest: str, refers_to: str | None,
                revisit: bool) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
            f"Content-Length: {len(block)}"]
    if url is not None:
        safe = "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url.decode("utf-8", "replace"))
        head.insert(3, f"WARC-Target-URI: {safe}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[str | None, int, str, str, str | None]:
    """page_id, payload size, digest, record type, page referred to."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest, kind = fields["warc-payload-digest"].partition(":")[2], fields["warc-type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"record {fields['warc-record-id']}: payload and digest differ")
    refers = fields.get("warc-refers-to")
    return page_of(fields["warc-record-id"]), size, digest, kind, page_of(refers) if refers else None


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class Package:
    """A ZIP file in the making; closed packages go to the shared folder in one write."""

    def __init__(self, folder: str):
        self.folder, self.data, self.lines = folder, io.BytesIO(), []

    def add(self, page_id: str | None, record: bytes) -> None:
        at = self.data.tell()
        self.data.write(gzip.compress(record, 1, mtime=0))
        self.lines.append(json.dumps({"page_id": page_id, "offset": at, "length": self.data.tell() - at}))

    def close(self) -> tuple[str, int]:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
            z.writestr(zipfile.ZipInfo(ARCHIVE), self.data.getvalue())
            z.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.lines))
        fs, path = pafs.FileSystem.from_uri(self.folder)
        fs.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.zip"
        with fs.open_output_stream(f"{path}/{name}") as f:
            f.write(out.getbuffer())
        return f"{self.folder}/{name}", len(self.lines)


def packer(folder: str, package_bytes: int):
    """(page_id, url, html, first_id, many) to packages; yields the manifest."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[str, int]] = []
        package = None
        for b in it:
            cols = [b.column(0).to_pylist(), binary_list(b.column(1)), binary_list(b.column(2)),
                    b.column(3).to_pylist(), b.column(4).to_pylist()]
            for page_id, url, html, first, many in zip(*cols, strict=True):
                package = package or Package(folder)
                payload = html or b""
                revisit = bool(many) and first is not None and first != page_id
                package.add(page_id, warc_record(page_id, url, payload, base32_sha1(payload), first, revisit))
                if package.data.tell() >= package_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()),
                                          pa.array([n for _, n in done], pa.int64())], names=["path", "records"])

    return run


class Member(NamedTuple):
    name: str
    method: int
    size: int  # as stored
    header: int  # offset of the local header


def zip64_field(extra: bytes, missing: list[bool]) -> list[int]:
    """The 64-bit values of those of (size, stored size, offset) that the 32-bit fields leave out."""
    at = 0
    while at + 4 <= len(extra):
        tag, n = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            return list(struct.unpack_from(f"<{sum(missing)}Q", extra, at + 4))
        at += 4 + n
    raise ValueError("a ZIP64 member without its extra field")


def central_directory(f) -> list[Member]:
    """The members of a ZIP or ZIP64 file; ``f`` has size() and read_at(length, offset)."""
    size = f.size()
    tail = f.read_at(min(size, 22 + 65535), max(0, size - 22 - 65535))
    base, at = size - len(tail), tail.rfind(EOCD)
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file, or cut off")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = f.read_at(20, base + at - 20)
        if locator[:4] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        record = f.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
        if record[:4] != EOCD64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    raw, at, out = f.read_at(length, start), 0, []
    for _ in range(count):
        if raw[at:at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", raw, at + 10)
        stored, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", raw, at + 20)
        header, = struct.unpack_from("<I", raw, at + 42)
        name = raw[at + 46:at + 46 + n_name].decode("utf-8", "replace")
        missing = [full == 0xFFFFFFFF, stored == 0xFFFFFFFF, header == 0xFFFFFFFF]
        if any(missing):
            wide = zip64_field(raw[at + 46 + n_name:at + 46 + n_name + n_extra], missing)
            full = wide.pop(0) if missing[0] else full
            stored = wide.pop(0) if missing[1] else stored
            header = wide.pop(0) if missing[2] else header
        out.append(Member(name, method, stored, header))
        at += 46 + n_name + n_extra + n_comment
    return out


def data_start(f, m: Member) -> int:
    head = f.read_at(30, m.header)
    if head[:4] != LOCAL:
        raise ValueError(f"{m.name}: no local header")
    if m.method != 0:
        raise ValueError(f"{m.name} is compressed; ranges need a stored member")
    return m.header + 30 + sum(struct.unpack_from("<HH", head, 26))


def read_package(f) -> Iterator[tuple]:
    """All records of a package, each by a range read; the file is never extracted."""
    members = {m.name: m for m in central_directory(f)}
    index, archive = members[INDEX], data_start(f, members[ARCHIVE])
    for line in f.read_at(index.size, data_start(f, index)).decode().split("\n"):
        if line:
            where = json.loads(line)
            if where["offset"] + where["length"] > members[ARCHIVE].size:
                raise ValueError("the index points beyond the archive")
            yield parse_record(gzip.decompress(f.read_at(where["length"], archive + where["offset"])))


def reader(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    for b in it:
        for path in b.column(0).to_pylist():
            fs, p = pafs.FileSystem.from_uri(path)
            with fs.open_input_file(p) as f:
                cols = list(zip(*read_package(f), strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def write_packages(pages: DataFrame, min_bytes: int = 0, package_bytes: int = 32 << 20) -> DataFrame:
    """Write every page; the manifest (path, records) of the packages."""
    html = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select(F.col("page_id").alias("page_id"), "url", html.alias("html")).select(
        "*", F.sha1(F.col("html").cast("binary")).alias("sha"), F.octet_length("html").cast("long").alias("size"))
    first = (base.where(F.col("size") >= min_bytes).groupBy("sha", "size")
             .agg(F.min("page_id").cast("string").alias("first_id"), F.count("*").alias("n"))
             .where(F.col("n") > 1).select("sha", "size", "first_id", F.lit(True).alias("many")))
    rows = base.join(first, ["sha", "size"], "left").select(F.col("page_id").cast("string"), "url", "html", "first_id", "many")
    return materialise(rows.mapInArrow(packer(shared_dir(pages.sparkSession), package_bytes), "path string, records long"))


def read_packages(manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record; ids as text."""
    n = max(1, manifest.count())
    return manifest.select("path").repartition(n).mapInArrow(reader, SCHEMA)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages and read the packages back; ids in the type of page_id."""
    kind = pages.schema["page_id"].dataType
    back = read_packages(write_packages(pages, min_bytes))
    return back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"))


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
digits AS (
  SELECT *, list_transform(range(0, 8), lambda i: CAST('0x' || substr(sha, CAST(5 * i + 1 AS INTEGER), 5) AS BIGINT)) AS q FROM p),
coded AS (
  SELECT *, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((q[CAST(i // 4 + 1 AS INTEGER)] >> CAST(15 - 5 * (i % 4) AS INTEGER)) % 32 + 1 AS INTEGER), 1)), 'string_agg', '') AS payload_digest
  FROM digits),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY sha, payload_bytes) AS f FROM coded)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = f THEN NULL ELSE f END AS refers_to
FROM firsts
"""
