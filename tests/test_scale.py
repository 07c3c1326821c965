"""The building blocks against plain Python, with one group holding a third of the rows."""

from itertools import groupby

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablehandoff import scale

# 60 of 180 rows belong to one key; a null key is a group of its own.
DATA = [("hot" if i % 3 == 0 else None if i % 10 == 1 else f"k{i % 7}", (i * 37) % 180, i % 5) for i in range(180)]


@pytest.fixture(autouse=True)
def small_partitions(spark):
    """Tiny partitions would be merged into one, and nothing would be cut."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


@pytest.fixture
def skewed(spark):
    return spark.createDataFrame(DATA, "k string, at int, w int").repartition(5)


def by_group():
    key = lambda r: (r[0] is not None, r[0] or "", r[1])
    for _, group in groupby(sorted(DATA, key=key), key=lambda r: r[0]):
        yield list(group)


@pytest.mark.parametrize("limit", [10, 40, 1000])
def test_running_total(skewed, limit):
    out = scale.running_total(skewed, ["k"], ["at"], F.col("w"), "before", limit)
    want, total = [], 0
    for group in by_group():
        total = 0
        for r in group:
            want.append((*r, total))
            total += r[2]
    assert rows(out) == sorted(want, key=lambda r: tuple(str(x) for x in r))


@pytest.mark.parametrize("limit", [10, 1000])
def test_running_total_descending(skewed, limit):
    out = scale.running_total(skewed, ["k"], [F.col("at").desc()], F.lit(1), "rank", limit)
    want = [(*r, i) for group in by_group() for i, r in enumerate(reversed(group))]
    assert rows(out) == sorted(want, key=lambda r: tuple(str(x) for x in r))


@pytest.mark.parametrize("limit", [10, 40, 1000])
def test_next_in_group(skewed, limit):
    out = scale.next_in_group(skewed, ["k"], ["at"], "at", "following", limit)
    want = []
    for group in by_group():
        for r, nxt in zip(group, [*group[1:], None]):
            want.append((*r, nxt[1] if nxt else None))
    assert rows(out) == sorted(want, key=lambda r: tuple(str(x) for x in r))


def test_runs_are_bounded(spark):
    data = [("hot", i) for i in range(2000)] + [("cold", i) for i in range(10)]
    df = spark.createDataFrame(data, "k string, at int")
    light, hot = scale.ordered_runs(df, ["k"], ["at"], 100)
    biggest = hot.groupBy("k", "_run").count().agg(F.max("count")).first()[0]
    assert biggest <= 1000 and (light.count(), hot.count()) == (10, 2000)
    assert scale.ordered_runs(df, ["k"], ["at"], 2000)[1] is None


def test_position(skewed):
    out = scale.with_position(skewed, ["at"])
    want = [(*r, i) for i, r in enumerate(sorted(DATA, key=lambda r: r[1]))]
    assert rows(out) == sorted(want, key=lambda r: tuple(str(x) for x in r))


def test_heavy_groups(skewed):
    found = scale.heavy_groups(skewed, ["k"], 30)
    assert [r[0] for r in found.keys.collect()] == ["hot"]
    assert scale.heavy_groups(skewed, ["k"], 60) is None
    weighed = scale.heavy_groups(skewed, ["k"], 100, weight=F.col("w"))
    assert [r[0] for r in weighed.keys.collect()] == ["hot"]


def test_many_heavy_groups_are_not_collected(skewed, monkeypatch):
    monkeypatch.setattr(scale, "bounded", lambda df, max_rows=2: None)
    found = scale.heavy_groups(skewed, ["k"], 5)
    light, hot = scale.split_heavy(skewed, ["k"], found)
    assert light.count() + hot.count() == len(DATA)
    assert hot.where("k = 'hot'").count() == 60


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_anti_join(spark, skewed, broadcast):
    right = spark.createDataFrame([("hot",), ("k1",), ("hot",), ("none",), (None,)], "k string")
    want = [r for r in DATA if r[0] not in ("hot", "k1")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        out = scale.anti_join(skewed, right, ["k"])
        assert rows(out) == sorted(want, key=lambda r: tuple(str(x) for x in r))
        hot_kept = scale.anti_join(skewed, right.where("k <> 'hot'"), ["k"])
        assert hot_kept.where("k = 'hot'").count() == 60
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join LeftAnti") == 1 and "Aggregate" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
