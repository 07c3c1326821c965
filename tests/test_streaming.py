"""Landing directories: waiting, loading, replay, identical content, newest per branch."""

import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablehandoff.operators import history
from tablehandoff.sinks import tables
from tablehandoff.streaming import landing

SCHEMA = "k STRING, n INT"


def put(folder, name, body):
    Path(folder).mkdir(exist_ok=True)
    Path(folder, name).write_text(body)


def test_watch_finds_a_late_file(spark, folder):
    box = f"{folder}/box"
    put(box, "other.csv", "x")
    timer = threading.Timer(2, lambda: put(box, "student_1.csv", ""))
    timer.start()
    assert landing.watch_landing(spark, box + "/", "student_", 60, 0.2) == f"{box}/student_1.csv"


def test_watch_times_out(spark, folder):
    put(f"{folder}/box", "other.csv", "x")
    start = time.time()
    with pytest.raises(TimeoutError, match=r"no file starting with 'student_' appeared in .*box within 1s"):
        landing.watch_landing(spark, f"{folder}/box", "student_", 1, 0.2)
    assert time.time() - start < 30


def test_stream_upload_equals_batch(spark, folder):
    box, target, check = f"{folder}/box", f"{folder}/t", f"{folder}/c"
    put(box, "student_1.csv", "k,n\na,1\nb,2\n")
    put(box, "other.csv", "k,n\nz,9\n")
    for extra in (None, "k,n\nc,3\n"):
        if extra:
            put(box, "student_2.csv", extra)
        stream = landing.landing_rows(spark, box, "student_", SCHEMA)
        landing.stream_upload(stream, target, check).awaitTermination()
    batch = spark.read.schema(SCHEMA).option("header", True).csv([f"{box}/student_1.csv", f"{box}/student_2.csv"])
    assert rows(spark.read.parquet(target).select("k", "n")) == rows(batch)


def test_replayed_batch_replaces_itself(spark, folder):
    df = spark.createDataFrame([("a", 1)], SCHEMA)
    for _ in range(2):
        tables.append_history(df, f"{folder}/t", "0")
    assert spark.read.parquet(f"{folder}/t").count() == 1


def test_another_checkpoint_keeps_what_is_loaded(spark, folder):
    target = f"{folder}/t"
    for n in (1, 2):
        put(f"{folder}/box{n}", "student.csv", f"k,n\na,{n}\n")
        stream = landing.landing_rows(spark, f"{folder}/box{n}", "student", SCHEMA)
        landing.stream_upload(stream, target, f"{folder}/c{n}").awaitTermination()
    assert rows(spark.read.parquet(target).select("k", "n")) == [("a", 1), ("a", 2)]


def test_skip_identical(spark, folder):
    box, target, state, check = (f"{folder}/{n}" for n in ("box", "t", "s", "c"))

    def run():
        files = landing.landing_files(spark, box, "f")
        landing.skip_identical(files, target, state, check).awaitTermination()
        return sorted(bytes(r.content) for r in spark.read.parquet(target).collect())

    put(box, "f1", "same")
    put(box, "f2", "same")
    put(box, "f3", "else")
    assert run() == [b"else", b"same"]
    put(box, "f4", "same")
    assert run() == [b"else", b"same"]
    put(box, "f5", "new")
    assert run() == [b"else", b"new", b"same"]
    assert spark.read.parquet(state).count() == 3


def test_state_of_many_batches_stays_small(spark, folder, monkeypatch):
    from tablehandoff import storage
    from tablehandoff.sinks import versions

    monkeypatch.setattr(landing, "STATE_BATCHES", 3)
    monkeypatch.setattr(landing.compact_hashes, "__defaults__", (3,))
    box, target, state, check = (f"{folder}/{n}" for n in ("box", "t", "s", "c"))
    for i in range(14):
        put(box, f"f{i:02d}", f"content {i % 9}")
        stream = landing.landing_files(spark, box, "f")
        landing.skip_identical(stream, target, state, check).awaitTermination()
        held = [n for n in storage.folder_names(spark, state) if n.startswith("batch=")]
        assert len(held) <= 4
    assert sorted(bytes(r.content).decode() for r in spark.read.parquet(target).collect()) == [f"content {i}" for i in range(9)]
    # A replay of the latest batch finds what it recorded itself to be its own, and nothing else.
    own = landing.batch_name(check, 13)
    assert {r.hash for r in landing.seen_hashes(spark, state, own).distinct().collect()} == {r.hash for r in spark.read.parquet(target).collect()}
    assert versions.current(spark, f"{state}/_base") is not None
    # Bytes staged for a batch do not stay.
    base = spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/tablehandoff"
    assert not [n for n in storage.folder_names(spark, base) if n.startswith("arrived")]


def test_latest_per_branch_equals_batch(spark, folder):
    box, check = f"{folder}/box", f"{folder}/c"
    put(box, "p1.csv", "k,n\na,1\nb,5\na,3\n")
    put(box, "p2.csv", "k,n\na,2\nb,6\nc,1\n")
    stream = landing.landing_rows(spark, box, "p", SCHEMA, max_files=1).select("k", "n", F.lit("x").alias("v"))
    latest = landing.latest_per_branch(stream, ["k"], ["n"])
    query = (
        latest.writeStream.outputMode("update").option("checkpointLocation", check).trigger(availableNow=True)
        .foreachBatch(lambda df, _: tables.write_upsert(f"{folder}/state", df, ["k"], ["n"], "k")).start()
    )
    query.awaitTermination()
    batch = spark.read.schema(SCHEMA).option("header", True).csv(box).withColumn("v", F.lit("x"))
    want = history.latest_per_key(batch, ["k"], ["n"])
    assert rows(spark.read.parquet(f"{folder}/state").select("k", "n", "v")) == rows(want)
