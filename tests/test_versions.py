"""Versioned tables: whole rows after a stop at any step, for readers and for the next writer."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablehandoff import storage
from tablehandoff.sinks import tables, versions

SCHEMA = "k int, v string"


class Stopped(Exception):
    pass


def table_of(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], SCHEMA).repartition(2)


# The steps of a refresh, by the function that takes them: a stop before each, and after each.
STEPS = ["write_text", "rename", "delete"]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("call", [0, 1])
def test_a_stop_at_any_step_leaves_whole_rows(spark, folder, monkeypatch, step, after, call):
    old, new = ["a", "b", "c"], ["d", "e"]
    for values in (["x"], ["y", "z"], old):  # older versions give the clean something to remove
        tables.refresh_staging(table_of(spark, *values), "j", folder)
    before = tables.read_staging(spark, "j", folder)
    real, calls = getattr(storage, step), []

    def stop(*args):
        calls.append(args)
        if len(calls) == call + 1:
            if after:
                real(*args)
            raise Stopped
        return real(*args)

    with monkeypatch.context() as patch:
        patch.setattr(storage, step, stop)
        try:
            tables.refresh_staging(table_of(spark, *new), "j", folder)
        except Stopped:
            pass
    published = step == "delete" or len(calls) <= call or (step == "rename" and after)
    want = sorted(new if published else old)
    assert sorted(r.v for r in tables.read_staging(spark, "j", folder).collect()) == want
    assert sorted(r.v for r in before.collect()) == sorted(old)  # who began to read reads on
    again = tables.refresh_staging(table_of(spark, "f"), "j", folder)
    assert [r.v for r in again.collect()] == [r.v for r in tables.read_staging(spark, "j", folder).collect()] == ["f"]


def test_a_failed_write_leaves_the_old_rows(spark, folder):
    tables.refresh_staging(table_of(spark, "a"), "j", folder)
    with pytest.raises(Exception):
        broken = table_of(spark, "b").withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
        tables.refresh_staging(broken, "j", folder)
    assert rows(tables.read_staging(spark, "j", folder)) == [(0, "a")]


def test_fingerprint_and_rows_change_together(spark, folder, monkeypatch):
    path = f"{folder}/t"
    assert tables.materialize_if_changed(table_of(spark, "a"), "1", path)
    real = storage.rename
    monkeypatch.setattr(storage, "rename", lambda *a: (_ for _ in ()).throw(Stopped()))
    with pytest.raises(Stopped):
        tables.materialize_if_changed(table_of(spark, "b"), "2", path)
    monkeypatch.setattr(storage, "rename", real)
    assert versions.current(spark, path).note == "1" and rows(versions.read_current(spark, path)) == [(0, "a")]
    assert tables.materialize_if_changed(table_of(spark, "b"), "2", path)
    assert not tables.materialize_if_changed(table_of(spark, "c"), "2", path)
    assert rows(versions.read_current(spark, path)) == [(0, "b")]


def test_two_writers_and_old_versions(spark, folder):
    path = f"{folder}/t"
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, path)
    first, second = versions.write_version(table_of(spark, "a"), path), versions.write_version(table_of(spark, "b"), path)
    versions.publish(spark, path, first)
    # Another writer saw the same numbers: its rename finds the number taken.
    storage.write_text(spark, f"{path}/_late", "{}")
    with pytest.raises(Exception):
        storage.rename(spark, f"{path}/_late", f"{path}/{versions.POINTER.format(1)}")
    assert rows(versions.read_current(spark, path)) == [(0, "a")]
    versions.publish(spark, path, second)
    for i in range(4):
        versions.replace(table_of(spark, str(i)), path)
    assert versions.pointers(spark, path) == [5, 6]
    assert rows(versions.read_current(spark, path)) == [(0, "3")]
    assert not storage.exists(spark, f"{path}/{first}")
    # A version published again is not removed while a kept pointer names it.
    now = versions.current(spark, path).version
    for _ in range(3):
        versions.publish(spark, path, now)
        versions.clean(spark, path, keep=1)
    assert rows(versions.read_current(spark, path)) == [(0, "3")]


def test_many_files_are_delivered_together(spark, folder, monkeypatch):
    from tablehandoff.sinks import files

    path = f"{folder}/out"
    first = spark.createDataFrame([(i, f"a{i},\"") for i in range(100)], SCHEMA)
    pointer = files.deliver_version(first, path, "csv", ["k"], 10)
    assert pointer.note == "100" and len(storage.file_names(spark, f"{path}/{pointer.version}")) >= 10
    read = lambda: rows(versions.read_current(spark, path, first.schema, "csv", header=True, escape='"'))
    assert read() == rows(first)
    with pytest.raises(files.LayoutError):
        files.deliver_version(first.withColumn("v", F.lit("a\nb")), path, "csv", ["k"], 10)
    with monkeypatch.context() as patch:
        patch.setattr(storage, "rename", lambda *a: (_ for _ in ()).throw(Stopped()))
        with pytest.raises(Stopped):
            files.deliver_version(first.limit(5), path, "csv", ["k"], 10)
    assert read() == rows(first)
    assert files.deliver_version(first.limit(0), path, "json", ["k"], 10).note == "0"
    assert versions.read_current(spark, path, first.schema, "json").count() == 0
