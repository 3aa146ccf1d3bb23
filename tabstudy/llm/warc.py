"""WARC records in ZIP packages: written as stored members with an index, read by byte ranges.

A package holds ``archive/data.warc.gz`` (one gzip member per record), ``indexes/index.cdxj`` (one line
per record: key, time, JSON with member, offset and length) and ``datapackage.json``. All members
are stored, so that a record is one byte range of the package. A reader fetches the end of
the file, the ZIP64 records, the central directory and the index, then the records' ranges;
nothing is extracted. Files are reached through ``pyarrow.fs``, so the folder may be any store
that it opens by URI.
"""

from __future__ import annotations

import gzip
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

DATA_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
ABOUT_MEMBER = "datapackage.json"
PACKAGE_BYTES = 32 << 20  # compressed bytes after which a task starts another package
RANGE_BYTES = 4 << 20  # bytes fetched at once when reading records
TASK_BYTES = 32 << 20  # bytes of packages to a reading task
LEAST_REVISIT = 1000

# fixed values of the ZIP format
LOCAL, CENTRAL, END, END64, LOCATOR64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
ZIP64_FIELD = 1
DOS_DATE = (1980 - 1980) << 9 | 1 << 5 | 1


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(path)


@dataclass
class Member:
    """A file inside a package; ``offset`` is where its own bytes begin."""

    name: str
    method: int
    crc: int
    packed: int
    size: int
    offset: int


class PackageWriter:
    """Streams stored members to a ZIP package with ZIP64 sizes and directory."""

    def __init__(self, sink):
        self.sink, self.at, self.entries = sink, 0, []

    def write(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        """Sizes follow the data in a ZIP64 data descriptor (flag bit 3)."""
        raw = name.encode()
        self.entry = [raw, self.at, 0, 0]
        extra = struct.pack("<HHQQ", ZIP64_FIELD, 16, 0, 0)
        self.write(
            struct.pack(
                "<IHHHHHIIIHH", LOCAL, 45, 1 << 3 | 1 << 11, 0, 0, DOS_DATE, 0, FULL32, FULL32, len(raw), len(extra)
            )
            + raw
            + extra
        )

    def add(self, data: bytes) -> None:
        self.entry[2] = zlib.crc32(data, self.entry[2])
        self.entry[3] += len(data)
        self.write(data)

    def end(self) -> None:
        raw, start, crc, size = self.entry
        self.write(struct.pack("<IIQQ", 0x08074B50, crc, size, size))
        self.entries.append((raw, start, crc, size))

    def close(self) -> None:
        begin = self.at
        for raw, start, crc, size in self.entries:
            extra = struct.pack("<HHQQQ", ZIP64_FIELD, 24, size, size, start)
            self.write(
                struct.pack(
                    "<IHHHHHHIIIHHHHHII",
                    CENTRAL, 45, 45, 1 << 3 | 1 << 11, 0, 0, DOS_DATE, crc, FULL32, FULL32,
                    len(raw), len(extra), 0, 0, 0, 0, FULL32,
                )
                + raw
                + extra
            )
        length, end64 = self.at - begin, self.at
        n = len(self.entries)
        self.write(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, length, begin))
        self.write(struct.pack("<IIQI", LOCATOR64, 0, end64, 1))
        self.write(struct.pack("<IHHHHIIH", END, 0, 0, min(n, FULL16), min(n, FULL16), FULL32, FULL32, 0))


def read_directory(source, size: int) -> list[Member]:
    """Members of a package, from its end records and central directory alone.

    ``source`` has ``read_at(nbytes, offset)``. Reads the last 64 KiB, the ZIP64 end record if there is one, the
    directory, and 30 bytes of each member's local header.
    """
    tail_at = max(0, size - (22 + FULL16))
    tail = source.read_at(size - tail_at, tail_at)
    at = tail.rfind(struct.pack("<I", END), 0, max(0, len(tail) - 18))
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(struct.pack("<I", END), 0, at)
    if at < 0:
        raise ValueError("no ZIP end record")
    count, length, begin = struct.unpack_from("<HII", tail, at + 10)
    if FULL16 == count or FULL32 in (length, begin):
        where = tail_at + at - 20
        locator = source.read_at(20, where) if where >= 0 else b""
        if len(locator) == 20 and struct.unpack_from("<I", locator)[0] == LOCATOR64:
            end64 = struct.unpack_from("<Q", locator, 8)[0]
            head = source.read_at(56, end64)
            if struct.unpack_from("<I", head)[0] != END64:
                raise ValueError("broken ZIP64 end record")
            count, length, begin = struct.unpack_from("<QQQ", head, 32)
    directory, members, at = source.read_at(length, begin), [], 0
    for _ in range(count):
        fields = struct.unpack_from("<IHHHHHHIIIHHHHHII", directory, at)
        if fields[0] != CENTRAL:
            raise ValueError("broken ZIP directory")
        method, crc, packed, plain, start = fields[4], fields[7], fields[8], fields[9], fields[16]
        names, extras, comments = fields[10:13]
        name = directory[at + 46 : at + 46 + names].decode("utf-8", "replace")
        extra = directory[at + 46 + names : at + 46 + names + extras]
        where = 0
        while where + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, where)
            if kind == ZIP64_FIELD:
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, where + 4))
                plain = next(wide) if plain == FULL32 else plain
                packed = next(wide) if packed == FULL32 else packed
                start = next(wide) if start == FULL32 else start
            where += 4 + n
        local = source.read_at(30, start)
        if struct.unpack_from("<I", local)[0] != LOCAL:
            raise ValueError(f"broken local header of {name}")
        own = sum(struct.unpack_from("<HH", local, 26))
        members.append(Member(name, method, crc, packed, plain, start + 30 + own))
        at += 46 + names + extras + comments
    return members


def build_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_headers(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) up to the first empty line, and what follows it."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    return fields, rest


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of one record."""
    fields, rest = parse_headers(data)
    block = rest[: int(fields["content-length"])]
    http, payload = parse_headers(block) if block.startswith(b"HTTP/") else ({}, block)
    return fields, http, payload


def _record(row) -> bytes:
    payload = b"" if row.record_type == "revisit" else bytes(row.payload)
    status = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row.payload_bytes}\r\n\r\n"
    headers = [
        ("WARC-Record-ID", f"<{row.record_id}>"),
        ("WARC-Target-URI", " ".join((row.uri or "").split())),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{row.payload_digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row.record_type == "revisit":
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<{row.refers_to}>"),
        ]
    return build_record(row.record_type, headers, status.encode() + payload)


def plan_revisits(records: DataFrame, key: str, least_bytes: int = LEAST_REVISIT) -> DataFrame:
    """``records`` (with ``payload`` binary) plus digest, length, ``record_type`` and ``refers_key``.

    Of records with equal payloads of at least ``least_bytes``, that with the largest ``key`` is the response.
    Digests are counted with a map-side combine; only digests found twice are joined back,
    and a digest that very many records share is one row on the other side of that join.
    """
    described = records.withColumn("payload_digest", F.sha1("payload")).withColumn(
        "payload_bytes", F.octet_length("payload").cast("bigint")
    )
    repeated = (
        described.where(F.col("payload_bytes") >= least_bytes)
        .groupBy(F.col("payload_digest").alias("__digest"))
        .agg(F.max(key).alias("__last"), F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > 1)
        .drop("__n")
    )
    revisit = F.col("__last").isNotNull() & ~F.col(key).eqNullSafe(F.col("__last"))
    return (
        described.join(repeated, F.col("payload_digest") == F.col("__digest"), "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_key", F.when(revisit, F.col("__last")))
        .drop("__digest", "__last")
    )


def write_packages(records: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write records to packages below ``folder``; returns (path, bytes, records), one row per package.

    ``records`` has record_id, uri, record_type, refers_to, payload_digest (strings), payload_bytes and payload.
    Each task streams its rows to packages of about ``package_bytes``, holding one record and the
    index of one package in memory. A task that is run again writes under new names, and only the
    names of the attempt that succeeded are in the result, so the result must be written
    or checkpointed once before it is read.
    """
    names = ["record_id", "uri", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = open_store(folder)
        store.create_dir(place, recursive=True)
        done, open_package = [], None

        def finish():
            writer, sink, path, index = open_package
            writer.end()
            writer.begin(INDEX_MEMBER)
            for line in index:
                writer.add(line)
            writer.end()
            writer.begin(ABOUT_MEMBER)
            writer.add(json.dumps({"profile": "data-package", "resources": [DATA_MEMBER, INDEX_MEMBER]}).encode())
            writer.end()
            writer.close()
            sink.close()
            done.append((path, writer.at, len(index)))

        for batch in batches:
            for piece in range(0, batch.num_rows, 200):
                for row in batch.slice(piece, 200).to_pandas().itertuples(index=False):
                    if open_package is None:
                        path = f"{place.rstrip('/')}/{uuid.uuid4().hex}.wacz"
                        sink = store.open_output_stream(path)
                        writer = PackageWriter(sink)
                        writer.begin(DATA_MEMBER)
                        open_package = (writer, sink, path, [])
                        base = writer.at
                    writer, _, _, index = open_package
                    packed = gzip.compress(_record(row), 6, mtime=0)
                    about = {"filename": DATA_MEMBER, "offset": writer.at - base, "length": len(packed)}
                    index.append(f"{row.record_id} 19700101000000 {json.dumps(about)}\n".encode())
                    writer.add(packed)
                    if writer.at >= package_bytes:
                        finish()
                        open_package = None
        if open_package is not None:
            finish()
        yield pa.RecordBatch.from_pydict(
            {
                "path": pa.array([d[0] for d in done], pa.string()),
                "bytes": pa.array([d[1] for d in done], pa.int64()),
                "records": pa.array([d[2] for d in done], pa.int64()),
            }
        )

    return records.select(*names).mapInArrow(written, "path string, bytes bigint, records bigint")


def reading_tasks(packages: DataFrame, task_bytes: int = TASK_BYTES) -> int:
    """Tasks for reading ``packages`` (with column bytes), by what they hold: their names' size says nothing of it."""
    total = packages.agg(F.sum("bytes")).first()[0] or 0
    return max(1, -(-total // task_bytes))


def list_records(packages: DataFrame, folder: str, tasks: int) -> DataFrame:
    """(path, offset, length) of every record: directory and index of each package, no record is read.

    Packages (column path) are dealt out to ``tasks`` tasks. Only stored members are located; a compressed member named by
    the index is an error, as its records have no byte range.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_file(path) as source:
                    members = {m.name: m for m in read_directory(source, source.size())}
                    offsets, lengths = [], []
                    for name, member in members.items():
                        if not name.startswith("indexes/"):
                            continue
                        raw = source.read_at(member.packed, member.offset)
                        text = raw if member.method == 0 else zlib.decompress(raw, -15)
                        for line in text.splitlines():
                            about = json.loads(line.split(b" ", 2)[2])
                            target = members[about["filename"]]
                            if target.method != 0:
                                raise ValueError(f"{path}: {target.name} is compressed")
                            offsets.append(target.offset + int(about["offset"]))
                            lengths.append(int(about["length"]))
                for begin in range(0, len(offsets), 10_000):
                    part = slice(begin, begin + 10_000)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "path": pa.array([path] * len(offsets[part]), pa.string()),
                            "at": pa.array(offsets[part], pa.int64()),
                            "length": pa.array(lengths[part], pa.int64()),
                        }
                    )

    return packages.select("path").repartition(tasks, "path").mapInArrow(listed, "path string, at bigint, length bigint")


def read_records(locations: DataFrame, folder: str, tasks: int, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records at (path, at, length): fields, and the payload a record carries itself.

    Locations are spread over ``tasks`` tasks by (path, stretch of ``range_bytes``), so that one large package is read by many tasks
    and neighbouring records in one request.
    """
    schema = (
        "record_id string, uri string, record_type string, refers_to string, declared_digest string, "
        "declared_bytes bigint, payload binary"
    )

    def fetched(source, group: pd.DataFrame) -> Iterator[bytes]:
        run = []
        for at, length in zip(group["at"], group["length"], strict=True):
            if run and (at != run[-1][0] + run[-1][1] or at + length - run[0][0] > range_bytes):
                yield from cut(source, run)
                run = []
            run.append((at, length))
        if run:
            yield from cut(source, run)

    def cut(source, run) -> Iterator[bytes]:
        first = run[0][0]
        data = source.read_at(run[-1][0] + run[-1][1] - first, first)
        for at, length in run:
            yield data[at - first : at - first + length]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = open_store(folder)
        for frame in frames:
            for path, group in frame.groupby("path", sort=False):
                with store.open_input_file(path) as source:
                    rows, held = [], 0
                    for raw in fetched(source, group.sort_values("at")):
                        data = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
                        fields, http, payload = parse_record(data)
                        rows.append(
                            (
                                fields["warc-record-id"].strip("<>"),
                                fields.get("warc-target-uri"),
                                fields["warc-type"],
                                fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
                                fields.get("warc-payload-digest", "").rpartition(":")[2],
                                int(http.get("content-length", len(payload))),
                                payload,
                            )
                        )
                        held += len(data)
                        if held > 2 * range_bytes:
                            yield pd.DataFrame(rows, columns=[p.split()[0] for p in schema.split(", ")])
                            rows, held = [], 0
                    if rows:
                        yield pd.DataFrame(rows, columns=[p.split()[0] for p in schema.split(", ")])

    stretch = F.floor(F.col("at") / F.lit(range_bytes))
    return locations.repartition(tasks, F.col("path"), stretch).mapInPandas(read, schema)
