"""Packages: round trips, the ZIP directory against zipfile, ranges against whole files."""

from __future__ import annotations

import gzip
import hashlib
import io
import zipfile

import pytest
from odd import duck_rows
from pyspark.sql import functions as F

from tabstudy.llm import warc
from tabstudy.llm.oracles import ARCHIVE
from tabstudy.llm.queries import op1_warc


class Source:
    def __init__(self, data: bytes):
        self.data, self.reads = data, []

    def read_at(self, n: int, at: int) -> bytes:
        self.reads.append((at, n))
        return self.data[at : at + n]


def package(members: dict[str, bytes]) -> bytes:
    sink = io.BytesIO()
    writer = warc.PackageWriter(sink)
    for name, data in members.items():
        writer.begin(name)
        writer.add(data[:3])
        writer.add(data[3:])
        writer.end()
    writer.close()
    return sink.getvalue()


def test_written_package_is_a_zip():
    members = {"a/b.txt": b"hello", "empty": b"", "größe": b"x" * 70_000}
    data = package(members)
    with zipfile.ZipFile(io.BytesIO(data)) as opened:
        assert opened.testzip() is None
        assert {i.filename: opened.read(i) for i in opened.infolist()} == members
    found = warc.read_directory(Source(data), len(data))
    assert {m.name: data[m.offset : m.offset + m.size] for m in found} == members
    assert all(m.method == 0 for m in found)


@pytest.mark.parametrize("comment", [b"", b"a comment PK\x05\x06 that misleads"])
def test_plain_zip_directories(comment):
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as made:
        made.writestr("one.warc", b"1" * 500)
        made.writestr(zipfile.ZipInfo("two"), b"2" * 50, zipfile.ZIP_DEFLATED)
        made.comment = comment
    data = sink.getvalue()
    found = {m.name: m for m in warc.read_directory(Source(data), len(data))}
    assert data[found["one.warc"].offset :][:500] == b"1" * 500
    assert found["two"].method == zipfile.ZIP_DEFLATED


def test_many_members_need_zip64():
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w") as made:
        for i in range(66_000):
            made.writestr(f"m{i}", b"")
    data = sink.getvalue()
    source = Source(data)
    assert len(warc.read_directory(source, len(data))) == 66_000


def test_directory_reads_no_member():
    data = package({"big": b"z" * 500_000, "small": b"s"})
    source = Source(data)
    warc.read_directory(source, len(data))
    assert sum(n for _, n in source.reads) < 70_000


def test_not_a_zip():
    with pytest.raises(ValueError):
        warc.read_directory(Source(b"no archive" * 10), 100)


def test_record_round_trip():
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\n\r\n\r\nx"
    record = warc.build_record("response", [("WARC-Record-ID", "<urn:x:1>")], block)
    fields, http, payload = warc.parse_record(record)
    assert (fields["warc-type"], http["content-length"], payload) == ("response", "5", b"\r\n\r\nx")


def odd_pages(spark):
    big = "<p>same</p>" * 200
    rows = [
        (1, "http://a/1", big), (2, "http://a/2", big), (3, None, big), (3, None, big), (None, "x y\r\nz", big),
        (4, "u", None), (5, "u", ""), (6, "u", "é" * 499), (7, "u", "é" * 499), (8, "u", "é" * 500), (9, "u", "é" * 500),
        (10, "u", "long " * 400_000), (-1, "u", "\r\n\r\nWARC/1.1\r\n"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string"), rows


def test_odd_pages(spark, tmp_path):
    frame, rows = odd_pages(spark)
    frame.withColumn("payload", F.lit("clash")).write.parquet(str(tmp_path / "pages.parquet"))
    got = op1_warc(spark, str(tmp_path)).collect()
    want = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        ids = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        revisit = len(body) >= 1000 and page_id != max(ids)
        want.append(
            (page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", max(ids) if revisit else None)
        )
    key = lambda r: tuple(str(x) for x in r)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[n] for n in names) for r in got), key=key) == sorted(want, key=key)


def test_pages_table(spark):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = sorted(tuple(r[n] for n in names) for r in op1_warc(spark, "/root/testdata/sf0.001").collect())
    assert got == sorted(duck_rows(ARCHIVE))


def records(spark, n: int):
    body = F.concat(F.lit("body "), F.col("id").cast("string"))
    return spark.range(n).select(
        F.concat(F.lit("urn:r:"), F.col("id").cast("string")).alias("record_id"),
        F.lit("http://h/").alias("uri"),
        F.lit("response").alias("record_type"),
        F.lit(None).cast("string").alias("refers_to"),
        F.sha1(body).alias("payload_digest"),
        F.octet_length(body).cast("bigint").alias("payload_bytes"),
        body.cast("binary").alias("payload"),
    )


def test_small_packages_and_ranges(spark, tmp_path):
    """Many packages, and many records per range request."""
    folder = str(tmp_path / "w")
    packages = warc.write_packages(records(spark, 500).coalesce(2), folder, package_bytes=5000).cache()
    assert packages.count() > 5 and packages.agg(F.sum("records")).first()[0] == 500
    for row in packages.collect():
        with zipfile.ZipFile(row["path"]) as opened:
            assert opened.testzip() is None
            whole = gzip.decompress(opened.read(warc.DATA_MEMBER))
            assert whole.count(b"WARC/1.1\r\n") == row["records"]
    for size in (100, 1 << 20):
        got = warc.read_records(warc.list_records(packages, folder, 3), folder, 4, size).collect()
        assert {(r["record_id"], bytes(r["payload"])) for r in got} == {(f"urn:r:{i}", f"body {i}".encode()) for i in range(500)}


def test_uncompressed_records_and_foreign_packages(spark, tmp_path):
    record = warc.build_record("response", [("WARC-Record-ID", "<urn:x:1>")], b"HTTP/1.1 200 OK\r\n\r\nhi")
    path = tmp_path / "f.wacz"
    index = f'k 1 {{"filename": "archive/x.warc", "offset": 0, "length": {len(record)}}}\n'
    with zipfile.ZipFile(path, "w") as made:
        made.writestr("archive/x.warc", record)
        made.writestr("indexes/index.cdx", index, zipfile.ZIP_DEFLATED)
    frame = spark.createDataFrame([(str(path),)], "path string")
    got = warc.read_records(warc.list_records(frame, str(tmp_path), 1), str(tmp_path), 1).collect()
    assert [(r["record_id"], bytes(r["payload"]), r["declared_bytes"]) for r in got] == [("urn:x:1", b"hi", 2)]


def test_no_records(spark, tmp_path):
    folder = str(tmp_path / "none")
    packages = warc.write_packages(records(spark, 0), folder).cache()
    assert packages.count() == 0
    tasks = warc.reading_tasks(packages)
    assert tasks == 1
    assert warc.read_records(warc.list_records(packages, folder, tasks), folder, tasks).collect() == []
