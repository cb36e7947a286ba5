import base64
import hashlib
import io
import struct
import zipfile

import pytest

from tidemark.llm import warc_zip as wz

SCHEMA = "page_id long, url string, html string, payload_bytes long, sha string"


def brute(rows, min_bytes=0):
    first = {}
    for i, _, h, *_ in rows:
        p = (h or "").encode()
        if i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, _, h, *_ in rows:
        p = (h or "").encode()
        f = first.get(p)
        revisit = f is not None and f != i and len(p) >= min_bytes
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", f if revisit else None))
    return out


ROWS = [
    (0, "http://a/", "<p>one</p>", 1, "x"), (1, "http://b/", "<p>two</p>", 1, "x"), (2, None, "<p>one</p>", 1, "x"), (3, "http://c/", None, 1, "x"),
    (4, "http://d/", "", 1, "x"), (None, "http://e/", "<p>one</p>", 1, "x"), (None, "http://f/", "<p>only</p>", 1, "x"),
    (5, "http://g/\r\nX: y", "ünï\r\n\r\n😀" * 50_000, 1, "x"), (0, "http://a/", "<p>one</p>", 1, "x"), (6, "http://h", "WARC/1.1\r\n\r\n", 1, "x"),
]
KEY = lambda r: (r[0] is None, r[0] or 0, r[2])


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    got = [tuple(r) for r in wz.round_trip(spark.createDataFrame(ROWS, SCHEMA), least).collect()]
    assert sorted(got, key=KEY) == sorted(brute(ROWS, least), key=KEY)


def test_empty_table(spark):
    assert wz.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_many_packages(spark):
    d = spark.createDataFrame([(i, f"http://x/{i}", f"page {i % 40}", 1, "x") for i in range(200)], SCHEMA)
    manifest = wz.write_packages(d, package_bytes=500)
    assert manifest.count() > 5
    assert {int(r.page_id) for r in wz.read_packages(manifest).collect()} == set(range(200))


class Bytes:
    """A file of bytes that counts what is read."""

    def __init__(self, data):
        self.data, self.read = data, 0

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        self.read += n
        return self.data[at:at + n]


def package(comment=b"", zip64=False):
    p = wz.Package("unused")
    for i in range(50):
        body = f"body {i} ".encode() * 200
        p.add(str(i), wz.warc_record(str(i), b"http://x/", body, wz.base32_sha1(body), None, False))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in (("readme.txt", b"hello"), (wz.ARCHIVE, p.data.getvalue()), (wz.INDEX, "\n".join(p.lines).encode())):
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as f:
                f.write(data)
        z.comment = comment
    return out.getvalue(), p


def as_zip64(raw):
    """The same file with ZIP64 central entries, end record and locator."""
    at = raw.rfind(wz.EOCD)
    count, length, start = struct.unpack_from("<HII", raw, at + 10)
    central, pos, new = raw[start:start + length], 0, b""
    for _ in range(count):
        stored, full, n, e, c = struct.unpack_from("<IIHHH", central, pos + 20)
        header, = struct.unpack_from("<I", central, pos + 42)
        extra = struct.pack("<HHI", 0xCAFE, 4, 7) + struct.pack("<HHQQQ", 1, 24, full, stored, header)
        entry = bytearray(central[pos:pos + 46])
        struct.pack_into("<IIHHH", entry, 20, 0xFFFFFFFF, 0xFFFFFFFF, n, len(extra), 0)
        struct.pack_into("<I", entry, 42, 0xFFFFFFFF)
        new += bytes(entry) + central[pos + 46:pos + 46 + n] + extra
        pos += 46 + n + e + c
    body = raw[:start] + new
    end64 = wz.EOCD64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, len(new), start)
    locator = wz.LOCATOR64 + struct.pack("<IQI", 0, len(body), 1)
    return body + end64 + locator + wz.EOCD + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)


@pytest.mark.parametrize("make", [lambda: package()[0], lambda: package(comment=b"PK hello")[0], lambda: package(zip64=True)[0],
                                  lambda: as_zip64(package()[0])])
def test_directories(make):
    got = list(wz.read_package(Bytes(make())))
    assert [g[0] for g in got] == [str(i) for i in range(50)] and all(g[3] == "response" for g in got)


def test_reads_ranges_only():
    raw, p = package()
    f = Bytes(raw)
    next(iter(wz.read_package(f)))
    index = sum(len(x) + 1 for x in p.lines)
    assert f.read < min(len(raw), 22 + 65535) + index + 2000


def test_broken_files():
    raw, _ = package()
    with pytest.raises(ValueError):
        wz.central_directory(Bytes(b"not a zip"))
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w", zipfile.ZIP_DEFLATED) as f:
        f.writestr(wz.ARCHIVE, b"x" * 100)
        f.writestr(wz.INDEX, b"")
    with pytest.raises(ValueError, match="stored"):
        list(wz.read_package(Bytes(z.getvalue())))
    body = wz.warc_record("1", b"http://x", b"abc", wz.base32_sha1(b"abd"), None, False)
    with pytest.raises(ValueError, match="digest"):
        wz.parse_record(body)
