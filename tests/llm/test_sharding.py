"""The law of the shards on mixed, hot, tiny and empty tables."""

import zlib
from collections import defaultdict

import pytest

from tablehandoff.llm.sharding import assign

SCHEMA = "doc_id long, text string, shard string, size string, `odd name` int"


def run(spark, folder, rows, **more):
    df = spark.createDataFrame([(i, t, "s", "z", 1) for i, t in rows], SCHEMA).repartition(5)
    df.write.mode("overwrite").parquet(folder + "/d")
    got = assign(spark.read.parquet(folder + "/d"), **more)
    assert got.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"),
                          ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    return got.collect()


def holds(rows, got, shards):
    want = sorted((i if i is not None else -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.text_crc32) for r in got) == want
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in got:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    total, most = sum(r.size for r in got), max((r.size for r in got), default=0)
    for s in range(shards):
        assert abs(sizes[s] - total / shards) <= most + 1


@pytest.mark.parametrize("shards", [1, 7, 24])
def test_law(spark, folder, shards):
    rows = [(i, "é" * (i % 97) + "x" * (i * 7 % 1000)) for i in range(3000)]
    holds(rows, run(spark, folder, rows, shards=shards), shards)


def test_hot_text_hot_row_nulls_and_long(spark, folder):
    rows = [(i, "copy of one text") for i in range(2000)] + [(7, "one row again and again")] * 2000
    rows += [(i, f"text {i}") for i in range(1500)] + [(None, None), (None, ""), (5, None), (9, "long " * 500)]
    holds(rows, run(spark, folder, rows), 24)


def test_few_rows_and_none(spark, folder):
    holds([(1, "a"), (2, "b")], run(spark, folder, [(1, "a"), (2, "b")]), 24)
    assert run(spark, folder, []) == []



def test_one_row_makes_up_most(spark, folder):
    rows = [(7, "again")] * 6000 + [(i, f"t {i}") for i in range(100)]
    holds(rows, run(spark, folder, rows), 24)
