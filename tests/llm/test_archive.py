"""Packages written and read back, foreign ZIP files, broken files."""

import gzip
import hashlib
import io
import zipfile

import pytest

from tablehandoff.llm import archive

SCHEMA = "page_id long, url string, html string, digest string, `key` string"


def reader(data):
    return lambda offset, size: data[offset : offset + size]


def brute(rows):
    out, first = [], {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    for i, u, h in rows:
        data = (h or "").encode()
        of = first.get(h) if len(data) >= 100 else None
        revisit = of is not None and of != i
        out.append((str(i), str(u), "revisit" if revisit else "response", None if revisit else data,
                    hashlib.sha256(data).hexdigest(), len(data), str(of) if revisit else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((str(r.id), str(r.url), r.record_type, None if r.payload is None else bytes(r.payload), r.payload_digest,
                    r.payload_bytes, r.refers_to) for r in df.collect()), key=str)


def write(spark, folder, rows, **more):
    spark.createDataFrame([(*r, "d", "k") for r in rows], SCHEMA).repartition(3).write.parquet(folder + "/pages")
    return archive.write_packages(spark.read.parquet(folder + "/pages"), f"file://{folder}/out", **more)


def test_round_trip(spark, folder):
    big, odd = "é" * 60, "line\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nPK\x05\x06" * 5
    rows = [(i, f"http://a/{i}%41?x=\t\r\nX: y", f"text {i} " * (i % 40)) for i in range(300)]
    rows += [(9001, "u", big), (9000, None, big), (9005, "u", big), (None, "u", big), (9000, "again", big)]
    rows += [(1000, "u", "small"), (1001, "u", "small"), (1002, "u", None), (1003, "u", ""), (1004, "u", odd), (1005, "u", odd)]
    rows += [(None, "u", "n" * 200), (None, "u", "n" * 200), (7, "long", "word " * 400_000)]
    packages = write(spark, folder, rows, package_bytes=4000)
    assert packages.count() > 3 and packages.agg({"records": "sum"}).first()[0] == len(rows)
    assert rows_of(archive.read_packages(packages)) == brute(rows)
    for r in packages.collect():
        with zipfile.ZipFile(r.path.removeprefix("file://")) as z:
            assert z.testzip() is None and sorted(z.namelist()) == ["archive/data.warc.gz", "indexes/index.cdxj"]


def test_empty_table(spark, folder):
    packages = write(spark, folder, [])
    assert packages.count() == 0 and archive.read_packages(packages).count() == 0


def record(i):
    return gzip.compress(archive.record(str(i), "u", b"x" * i, hashlib.sha256(b"x" * i).hexdigest(), i, None, "d"))


def test_foreign_packages(spark, folder):
    """Two archives, no index, a comment with a signature, other members."""
    with zipfile.ZipFile(folder + "/a.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("archive/a.warc.gz", b"".join(record(i) for i in range(5)))
        z.writestr("archive/b.warc.gz", b"".join(record(i) for i in range(5, 9)))
        z.writestr("pages/pages.jsonl", "x" * 1000, zipfile.ZIP_DEFLATED)
        z.comment = b"see PK\x05\x06 and so on, for more than a record's length"
    got = archive.read_packages(archive.packages_in(spark, [f"file://{folder}/a.zip"])).collect()
    assert sorted(int(r.id) for r in got) == list(range(9)) and all(len(r.payload) == int(r.id) for r in got)


def test_many_members_are_zip64():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(70_000):
            z.writestr(f"m{i}", b"")
    data = out.getvalue()
    members = archive.directory(reader(data), len(data))
    assert len(members) == 70_000 and members[-1].name == "m69999"
    assert archive.data_offset(reader(data), members[-1]) == members[-1].header + 30 + len("m69999")


def test_offsets_beyond_four_gigabytes():
    """The directory of a package whose members would end behind 4 GiB."""

    class Far(io.BytesIO):
        def close(self):
            pass

    out = Far()
    package = archive.Package(out)
    package.at = 5 << 32  # as if so much had been written
    package.begin("archive/data.warc.gz")
    package.write(b"abc")
    package.end()
    package.close()
    data = out.getvalue()
    before = b"\0" * 100_000

    def read(offset, size):
        at = offset - (5 << 32) + len(before)
        return (before + data)[at : at + size]

    (member,) = archive.directory(read, (5 << 32) + len(data))
    assert member.header == 5 << 32 and member.size == 3
    assert read(archive.data_offset(read, member), 3) == b"abc"


def test_broken_files():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("archive/a.warc.gz", b"abc" * 100, zipfile.ZIP_DEFLATED)
    data = out.getvalue()
    with pytest.raises(ValueError):
        archive.directory(reader(data[:-5]), len(data) - 5)
    with pytest.raises(ValueError):
        archive.directory(reader(b""), 0)
    with pytest.raises(ValueError):
        archive.data_offset(reader(data), archive.directory(reader(data), len(data))[0])
    wrong = archive.record("1", None, b"abc", "0" * 64, 3, None, "d")
    with pytest.raises(ValueError):
        archive.parse(wrong)
    cut = record(50)[:-4]
    with pytest.raises(ValueError):
        list(archive.scan_members(reader(cut), 0, len(cut)))
