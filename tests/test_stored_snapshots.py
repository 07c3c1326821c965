"""Bucketed snapshots against a comparison in plain Python."""

import random

from pyspark.sql import functions as F

from conftest import rows
from tablehandoff.sinks import snapshots

SCHEMA = "k string, `n.m` int, v string, w int, note string"
KEYS = ["k", "n.m"]


def fields(names=("v", "w")):
    return {n: F.col(n) for n in names}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_differences(spark, folder):
    draw = random.Random(7)
    keys = [(draw.choice([None, "", "null", f"k{i % 40}"]), draw.choice([None, 0, i % 9])) for i in range(400)]
    old = {k: (draw.choice([None, "", "a", "b"]), draw.choice([None, 1])) for k in keys[:300]}
    new = {k: draw.choice([old.get(k), ("a", None), (None, 1)]) or ("c", 2) for k in keys[100:]}
    tables = []
    for name, side in (("old_side", old), ("new_side", new)):
        df = spark.createDataFrame([(*k, *v, "x") for k, v in side.items()], SCHEMA).repartition(3)
        tables.append(snapshots.write_snapshot(df, name, f"{folder}/{name}", KEYS, fields(), 8))
    changes = snapshots.compare_snapshots(*tables, KEYS)
    want = [(*k, "added" if k not in old else "removed" if k not in new else "modified") for k in {*old, *new} if old.get(k) != new.get(k)]
    assert sorted(map(repr, map(tuple, changes.collect()))) == sorted(map(repr, want))
    cells = snapshots.compare_fields(*tables, KEYS)
    none = (None, None)
    json_of = lambda v: "{}" if v is None else '{"v":%s}' % (f'"{v}"' if isinstance(v, str) else v)
    want = [
        (*k, n, json_of(old.get(k, none)[i]), json_of(new.get(k, none)[i]))
        for k in {*old, *new} for i, n in enumerate(("v", "w")) if old.get(k, none)[i] != new.get(k, none)[i]
    ]
    assert sorted(map(repr, map(tuple, cells.collect()))) == sorted(map(repr, want))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (snapshots.compare_snapshots(*tables, KEYS), snapshots.compare_fields(*tables, KEYS)):
            plan = plan_of(df)
            assert "SortMergeJoin" in plan and "Exchange" not in plan and "SortAggregate" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_copies_of_a_key_and_columns_of_one_side(spark, folder):
    old = spark.createDataFrame([("h", 1, "a", 1, "")] * 500 + [("h", 1, "b", 1, "")] + [("z", 1, "q", 1, "")], SCHEMA)
    first = snapshots.write_snapshot(old, "copies", f"{folder}/a", KEYS, fields(), 4)
    again = snapshots.write_snapshot(old.repartition(5), "copies_again", f"{folder}/b", KEYS, fields(), 4)
    assert first.count() == 2 and snapshots.compare_snapshots(first, again, KEYS).count() == 0
    slim = snapshots.write_snapshot(old, "slim", f"{folder}/c", KEYS, fields(["v"]), 4)
    assert {r.field for r in snapshots.compare_fields(slim, first, KEYS).collect()} == {"w"}
    empty = snapshots.write_snapshot(old.limit(0), "none", f"{folder}/d", KEYS, fields(), 4)
    assert rows(snapshots.compare_snapshots(empty, first, KEYS)) == [("h", 1, "added"), ("z", 1, "added")]


def test_a_snapshot_of_another_session(spark, folder):
    df = spark.createDataFrame([("a", 1, "v", 1, "")], SCHEMA)
    snapshots.write_snapshot(df, "kept", f"{folder}/k", KEYS, fields(), 4)
    spark.sql("DROP TABLE kept")
    opened = snapshots.open_snapshot(spark, "kept_again", f"{folder}/k", 4)
    other = snapshots.write_snapshot(df.withColumn("w", F.lit(2)), "other", f"{folder}/o", KEYS, fields(), 4)
    changes = snapshots.compare_snapshots(opened, other, KEYS)
    assert rows(changes) == [("a", 1, "modified")] and "Exchange hashpartitioning" not in plan_of(changes)
