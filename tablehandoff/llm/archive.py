"""WARC records inside ZIP packages: written, located and range-read without extraction.

A package holds stored (uncompressed) members: ``archive/*.warc.gz``, in which every record is
a gzip member of its own, and ``indexes/*.cdxj`` with a line of JSON for each record: its
offset and length in the archive member. Packages are written with ZIP64 directories; the
reader takes either kind.

Paths are URIs that ``pyarrow.fs`` opens (local and mounted folders, hdfs, s3, gs). A package is
written under a name of its own and then moved into place.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehandoff.llm.frames import col, stored

# Signatures and sizes of the ZIP format (fixed values).
LOCAL, CENTRAL, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
END64, LOCATOR, DESCRIPTOR = b"PK\x06\x06", b"PK\x06\x07", b"PK\x07\x08"
LOCAL_SIZE, CENTRAL_SIZE, END_SIZE, END64_SIZE, LOCATOR_SIZE = 30, 46, 22, 56, 20
ALL16, ALL32 = 0xFFFF, 0xFFFFFFFF

# A package is closed once it holds so many bytes; neighbouring records are read together up to
# so many bytes.
PACKAGE_BYTES = 256 << 20
READ_BYTES = 4 << 20
# Records of one stretch of a package are read by one task.
STRETCH_BYTES = 8 << 20
# Payloads of fewer bytes are never revisits.
LEAST_REVISIT = 100


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class Member(NamedTuple):
    name: str
    method: int
    size: int  # as stored
    header: int  # offset of the local header


def _zip64(extra: bytes, values: list[int], limits: list[int]) -> list[int]:
    """Replaces the values that say "see the ZIP64 field" by those of that field."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            body, place = extra[at + 4 : at + 4 + size], 0
            for i, (v, most) in enumerate(zip(values, limits)):
                if v == most and place + 8 <= len(body):
                    values[i] = struct.unpack_from("<Q", body, place)[0]
                    place += 8
        at += 4 + size
    return values


def directory(read, length: int) -> list[Member]:
    """The members of a package, from its end: end record, ZIP64 locator and record, central
    directory. ``read(offset, size)`` gives bytes."""
    tail_at = max(0, length - END_SIZE - ALL16)
    tail = read(tail_at, length - tail_at)
    at = tail.rfind(END)
    while at >= 0 and (len(tail) - at < END_SIZE or at + END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)  # the signature inside a comment
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file, or cut off")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    if ALL16 == count or ALL32 in (size, start):
        place = tail_at + at - LOCATOR_SIZE
        locator = read(place, LOCATOR_SIZE) if place >= 0 else b""
        if locator[:4] == LOCATOR:
            record = read(struct.unpack_from("<Q", locator, 8)[0], END64_SIZE)
            if record[:4] != END64:
                raise ValueError("the ZIP64 locator points to no ZIP64 record")
            count, size, start = struct.unpack_from("<QQQ", record, 32)
    data, out, at = read(start, size), [], 0
    for _ in range(count):
        if data[at : at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", data, at + 10)[0]
        stored_size, full_size = struct.unpack_from("<II", data, at + 20)
        n, m, k = struct.unpack_from("<HHH", data, at + 28)
        header = struct.unpack_from("<I", data, at + 42)[0]
        extra = data[at + CENTRAL_SIZE + n : at + CENTRAL_SIZE + n + m]
        full_size, stored_size, header = _zip64(extra, [full_size, stored_size, header], [ALL32] * 3)
        name = data[at + CENTRAL_SIZE : at + CENTRAL_SIZE + n].decode("utf-8", "replace")
        out.append(Member(name, method, stored_size, header))
        at += CENTRAL_SIZE + n + m + k
    return out


def data_offset(read, member: Member) -> int:
    """Where the bytes of a member begin; only a stored member can be read in ranges."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed in the package")
    header = read(member.header, LOCAL_SIZE)
    if header[:4] != LOCAL:
        raise ValueError(f"no local header for {member.name}")
    n, m = struct.unpack_from("<HH", header, 26)
    return member.header + LOCAL_SIZE + n + m


class Package:
    """Writes stored members one after the other; sizes follow the data, always as ZIP64."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.header, self.crc = name.encode(), self.at, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        # Flag 8: sizes and checksum follow the data; flag 0x800: UTF-8 names.
        self._write(LOCAL + struct.pack("<HHHHHIIIHH", 45, 0x808, 0, 0, 33, 0, ALL32, ALL32, len(self.name), len(extra)))
        self._write(self.name + extra)
        self.data = self.at

    def write(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self._write(data)

    def end(self) -> None:
        size = self.at - self.data
        self._write(DESCRIPTOR + struct.pack("<IQQ", self.crc, size, size))
        self.members.append((self.name, self.crc, size, self.header))

    def close(self) -> None:
        start = self.at
        for name, crc, size, header in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, header)
            self._write(CENTRAL + struct.pack(
                "<HHHHHHIIIHHHHHII", 45, 45, 0x808, 0, 0, 33, crc, ALL32, ALL32, len(name), len(extra), 0, 0, 0, 0, ALL32
            ) + name + extra)
        size, end = self.at - start, self.at
        n = len(self.members)
        self._write(END64 + struct.pack("<QHHIIQQQQ", END64_SIZE - 12, 45, 45, 0, 0, n, n, size, start))
        self._write(LOCATOR + struct.pack("<IQI", 0, end, 1))
        self._write(END + struct.pack("<HHHHIIH", 0, 0, min(n, ALL16), min(n, ALL16), ALL32, ALL32, 0))
        self.out.close()


def _header(value: str) -> str:
    """A value on one header line: control characters and % as %XX."""
    return "".join(f"%{ord(c):02X}" if c == "%" or ord(c) < 32 or ord(c) == 127 else c for c in value)


def _plain(value: str) -> str:
    out, at = [], 0
    while (i := value.find("%", at)) >= 0:
        out += [value[at:i], chr(int(value[i + 1 : i + 3], 16))]
        at = i + 3
    return "".join(out) + value[at:]


def record(id: str | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: str | None, date: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit that names the response."""
    revisit = refers_to is not None
    http = b"" if revisit else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    unique = uuid.uuid5(uuid.NAMESPACE_URL, json.dumps([id, url, digest]))
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{unique}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    if id is not None:
        lines.append(f"X-Page-ID: {_header(id)}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"X-Refers-To-Page: {_header(refers_to)}")
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}",
              "Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + len(b'' if revisit else payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + (b"" if revisit else payload) + b"\r\n\r\n"


class Parsed(NamedTuple):
    id: str | None
    url: str | None
    type: str
    payload: bytes | None
    digest: str
    size: int
    refers_to: str | None


def parse(data: bytes) -> Parsed:
    """A record as written by ``record``. A payload that does not match its digest is an error."""
    head, _, body = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    body = body[: int(fields["Content-Length"])]
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["X-Payload-Length"])
    payload = None
    if fields["WARC-Type"] == "response":
        payload = body.partition(b"\r\n\r\n")[2]
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("a payload does not match its digest")
    text = lambda k: _plain(fields[k]) if k in fields else None
    return Parsed(text("X-Page-ID"), text("WARC-Target-URI"), fields["WARC-Type"], payload, digest, size, text("X-Refers-To-Page"))


def _package_rows(folder: str, date: str, package_bytes: int):
    """Writes the records of a partition into packages; a row for each package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        store.create_dir(base, recursive=True)
        package = None
        done: list[tuple[str, int, int]] = []

        def finish():
            package.end()
            package.begin("indexes/index.cdxj")
            for line in index:
                package.write(line)
            package.end()
            package.close()
            store.move(f"{base}/.{name}", f"{base}/{name}")
            done.append((f"{folder}/{name}", len(index), package.at))

        for batch in batches:
            for r in zip(*(batch.column(c) for c in ("id", "url", "payload", "digest", "bytes", "refers_to"))):
                id, url, payload, digest, size, refers_to = (x.as_py() for x in r)
                if package is None:
                    name, index = f"{uuid.uuid4().hex}.wacz", []
                    package = Package(store.open_output_stream(f"{base}/.{name}"))
                    package.begin("archive/data.warc.gz")
                packed = gzip.compress(record(id, url, payload.encode(), digest, size, refers_to, date), 3, mtime=0)
                index.append((json.dumps({"id": id, "offset": package.at - package.data, "length": len(packed)}) + "\n").encode())
                package.write(packed)
                if package.at >= package_bytes:
                    finish()
                    package = None
        if package is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
                ["path", "records", "bytes"],
            )

    return run


def write_packages(
    pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", payload: str = "html",
    least_revisit: int = LEAST_REVISIT, date: str = "2024-01-01T00:00:00Z", package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Writes a record for each row and returns a row for each package (path, records, bytes).

    A null payload counts as empty. Of rows with equal payloads of at least ``least_revisit``
    bytes, those with the smallest id are responses and the others revisit it; if none has an
    id, all are responses. A null id or url is left out of the record. No rows, no packages.
    Other columns are not read. Only names of finished packages are returned, so what a lost
    task has left does no harm.
    """
    whole = F.coalesce(col(payload).cast("string"), F.lit(""))
    rows = pages.select(
        col(id).alias("own"), col(url).cast("string").alias("url"), whole.alias("payload"),
        F.sha2(whole, 256).alias("digest"), F.octet_length(whole).cast("long").alias("bytes"),
    )
    shared = stored(
        rows.where(F.col("bytes") >= least_revisit).groupBy("digest")
        .agg(F.min("own").alias("first"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull()).select("digest", "first"),
        "first-payloads",
    )
    # Small payloads have no partner; a key of their own keeps them from piling up in one task.
    keyed = rows.withColumn("key", F.when(F.col("bytes") >= least_revisit, F.col("digest")).otherwise(F.monotonically_increasing_id().cast("string")))
    matched = keyed.join(shared.withColumnRenamed("digest", "key"), "key", "left")
    refers_to = F.when(~F.col("first").eqNullSafe(F.col("own")), F.col("first").cast("string"))
    records = matched.select(
        F.col("own").cast("string").alias("id"), "url",
        F.when(refers_to.isNull(), F.col("payload")).otherwise(F.lit("")).alias("payload"), "digest", "bytes",
        refers_to.alias("refers_to"),
    )
    return stored(records.mapInArrow(_package_rows(folder, date, package_bytes), "path string, records long, bytes long"), "packages")


def _reader(path: str):
    store, place = opened(path)
    file = store.open_input_file(place)

    def read(offset: int, size: int) -> bytes:
        return file.read_at(size, offset)

    return file, read


def scan_members(read, start: int, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of the gzip members between start and start + size, for want of an index."""
    at = 0
    while at < size:
        unzip, length = zlib.decompressobj(31), 0
        while not unzip.eof:
            block = read(start + at + length, min(READ_BYTES, size - at - length))
            if not block:
                raise ValueError("a record is cut off")
            unzip.decompress(block)
            length += len(block) - len(unzip.unused_data)
        yield at, length
        at += length


def located(path: str) -> Iterator[tuple[str, int, int]]:
    """(member, offset in the package, length) of every record of a package."""
    file, read = _reader(path)
    with file:
        members = directory(read, file.size())
        indexes = [m for m in members if m.name.startswith("indexes/") and m.name.endswith(".cdxj")]
        archives = [m for m in members if m.name.startswith("archive/") and m.name.endswith(".warc.gz")]
        for m in archives:
            start = data_offset(read, m)
            if len(archives) == 1 and len(indexes) == 1:
                lines = read(data_offset(read, indexes[0]), indexes[0].size).splitlines()
                places = ((x["offset"], x["length"]) for x in map(json.loads, lines))
            else:
                places = scan_members(read, start, m.size)
            for offset, length in places:
                if offset + length > m.size:
                    raise ValueError(f"the index of {path} points behind {m.name}")
                yield m.name, start + offset, length


def _located_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["path", "member", "offset", "length"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
    for batch in batches:
        for path in batch.column(0).to_pylist():
            block = []
            for place in located(path):
                block.append((path, *place))
                if len(block) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*block), kinds)], names)
                    block = []
            if block:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*block), kinds)], names)


def _record_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Range-reads the records; neighbours in one read."""
    current, file, read = None, None, None
    kinds = [pa.string(), pa.string(), pa.string(), pa.large_binary(), pa.string(), pa.int64(), pa.string()]
    names = ["id", "url", "record_type", "payload", "payload_digest", "payload_bytes", "refers_to"]
    for batch in batches:
        places = list(zip(batch.column("path").to_pylist(), batch.column("offset").to_pylist(), batch.column("length").to_pylist()))
        i = 0
        while i < len(places):
            path, start, _ = places[i]
            j, end = i, start
            while j < len(places) and places[j][0] == path and places[j][1] == end and (j == i or end + places[j][2] - start <= READ_BYTES):
                end += places[j][2]
                j += 1
            if path != current:
                if file is not None:
                    file.close()
                current, (file, read) = path, _reader(path)
            data = read(start, end - start)
            found = [parse(gzip.decompress(data[o - start : o - start + n])) for _, o, n in places[i:j]]
            columns = [
                [r.id for r in found], [r.url for r in found], [r.type for r in found], [r.payload for r in found],
                [r.digest for r in found], [r.size for r in found], [r.refers_to for r in found],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            i = j
    if file is not None:
        file.close()


def read_packages(packages: DataFrame, path: str = "path") -> DataFrame:
    """``id``, ``url``, ``record_type``, ``payload`` (binary; null for a revisit), ``payload_digest``,
    ``payload_bytes`` (both of the full payload) and ``refers_to`` of every record.

    Directories and indexes are read first; the records are then dealt out by stretches of the
    packages, so one large package is read by many tasks. A package without an index is read
    through; one that is cut off, compressed or does not match a digest is an error.
    """
    index = packages.select(col(path).alias("path")).where(F.col("path").isNotNull()).repartition("path").mapInArrow(
        _located_rows, "path string, member string, offset long, length long"
    )
    # A fixed number: rows of the index are small, the records they stand for are not.
    parts = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretch = F.floor(F.col("offset") / F.lit(STRETCH_BYTES))
    dealt = index.repartition(parts, "path", stretch).sortWithinPartitions("path", "offset")
    return dealt.select("path", "offset", "length").mapInArrow(
        _record_rows,
        "id string, url string, record_type string, payload binary, payload_digest string, payload_bytes long, refers_to string",
    )


def packages_in(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.createDataFrame([(p,) for p in paths], "path string")
