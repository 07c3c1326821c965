"""Rows by place against a sort of the whole table."""

import random
from datetime import date
from decimal import Decimal

import pytest

from tablehandoff import selection

SCHEMA = "k string, `n.m` double, d date, x decimal(9,2), tags array<string>, note string"


def order_of(row):
    """Nulls first, not-a-number last, as Spark sorts."""
    return tuple((v is not None, v != v, v if v == v else 0) if not isinstance(v, list) else (v is not None, False, v) for v in row)


@pytest.fixture(scope="module")
def table(spark):
    draw = random.Random(4)
    data = [("hot", 1.5, date(2024, 1, 1), Decimal("1.00"), ["a"], "same")] * 900
    for i in range(1500):
        data.append((
            draw.choice(["hot", None, "a", "z", f"k{i}"]), draw.choice([None, float("nan"), 0.5, float(i)]), draw.choice([None, date(2024, 1, 1 + i % 9)]),
            draw.choice([None, Decimal(i) / 4]), draw.choice([None, [], ["a"], ["b", str(i % 3)]]), draw.choice([None, "x", str(i)]),
        ))
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    return df, [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("limit", [300, 1_000_000])
@pytest.mark.parametrize("names", [["k"], ["n.m", "d"], ["note", "x"]])
def test_places(table, monkeypatch, names, limit):
    df, data = table
    monkeypatch.setattr(selection, "SORTED_ROWS", limit)
    monkeypatch.setattr(selection, "BOUNDS", 7)
    columns = selection.total_order(df, names)
    at = [df.columns.index(c) for c in columns]
    ordered = sorted(data, key=lambda r: order_of([r[i] for i in at]))
    for start, end in ((0, 10), (700, 950), (2390, 2500), (3000, 3010), (1200, 1201)):
        got = sorted(map(repr, map(tuple, selection.rows_between(df, names, start, end).collect())))
        assert got == sorted(map(repr, ordered[start:end])), (start, end)


def test_a_page_sorts_and_reads_little(spark, monkeypatch):
    df = spark.range(0, 200_000, 1, 8).selectExpr("id * 7919 % 200000 as k", "repeat('x', 50) as wide")
    monkeypatch.setattr(selection, "SORTED_ROWS", 10_000)
    page = selection.rows_between(df, ["k"], 100_000, 100_050)
    assert sorted(r.k for r in page.collect()) == list(range(100_000, 100_050))
    plan = page._jdf.queryExecution().toString()
    assert "RangePartitioning" not in plan and "checkpoint" not in plan.lower()


def test_one_value_fills_the_table(spark, monkeypatch):
    monkeypatch.setattr(selection, "SORTED_ROWS", 10)
    df = spark.createDataFrame([(1, {"a": 1})] * 500, "k int, m map<string,int>")
    assert selection.rows_between(df, ["k"], 100, 130).count() == 30
    assert selection.rows_between(df.limit(0), ["k"], 0, 10).count() == 0
    listed = spark.createDataFrame([([i],) for i in range(50)], "k array<int>")
    assert sorted(r.k[0] for r in selection.rows_between(listed, ["k"], 10, 20).collect()) == list(range(10, 20))
