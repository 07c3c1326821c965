"""Rows by their place in the total order of a table, without sorting the table.

A bounded sample gives bounds that cut the order into ranges. One pass over the order columns
counts the rows of each range, and the counts tell which ranges hold the wanted places. Only
those are sorted; one that is still large is cut again in the same way. A bound is a range of
its own, so a value that many rows share is told apart from its neighbours and needs no sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehandoff.scale import total_order

# Rows sampled for the bounds, and bounds taken from them.
SAMPLE, BOUNDS = 1024, 15
# Rows of one range that are sorted; a larger range is cut again.
SORTED_ROWS = 1_000_000

# Types whose values can be written into a plan as they are.
_PLAIN = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
    T.StringType, T.VarcharType, T.CharType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def plain_order(df: DataFrame, order_by: Sequence[str]) -> list[str]:
    """The columns of the total order up to the first that no bound can hold."""
    out = []
    for name in total_order(df, order_by):
        if not isinstance(df.schema[name].dataType, _PLAIN):
            break
        out.append(name)
    return out


def _place(df: DataFrame, names: Sequence[str]) -> Column:
    """The order columns as one value; a struct compares its fields in turn, nulls first."""
    return F.struct(*[F.col(f"`{n}`") for n in names])


def _literal(df: DataFrame, names: Sequence[str], row: Row) -> Column:
    return F.struct(*[F.lit(v).cast(df.schema[n].dataType).alias(n) for n, v in zip(names, row)])


def bounds(df: DataFrame, names: Sequence[str]) -> list[Row]:
    """Distinct rows of the order columns, in order, that cut the table into about equal ranges.

    The sample is drawn by a hash of the row and its place in the scan; every task hands on
    ``SAMPLE`` rows at most, and so many come to the driver.
    """
    columns = [F.col(f"`{n}`") for n in names]
    drawn = df.select(*columns).orderBy(F.xxhash64(*columns, F.monotonically_increasing_id())).limit(SAMPLE)
    found = drawn.coalesce(1).sortWithinPartitions(*columns).collect()
    step = max(1, -(-len(found) // (BOUNDS + 1)))
    out: list[Row] = []
    for row in found[step - 1 :: step]:
        if not out or row != out[-1]:
            out.append(row)
    return out


def range_number(place: Column, cuts: Sequence[Column], low: int = 0) -> Column:
    """2 i for places between bound i - 1 and bound i, 2 i + 1 for places at bound i: a search
    that halves the bounds, as one expression."""
    if not cuts:
        return F.lit(2 * low)
    middle = len(cuts) // 2
    cut = cuts[middle]
    return (
        F.when(place < cut, range_number(place, cuts[:middle], low))
        .when(place == cut, F.lit(2 * (low + middle) + 1))
        .otherwise(range_number(place, cuts[middle + 1 :], low + middle + 1))
    )


def rows_between(df: DataFrame, order_by: Sequence[str], start: int, end: int) -> DataFrame:
    """The rows at the places ``start`` to ``end - 1`` (from 0) of the total order of ``df``.

    The other columns break ties (maps aside, they have no order; behind a struct or an array
    only within a sorted range), so places do not depend on partitions. Rows alike in all of
    them are interchangeable. Order columns are read twice for each cut, whole rows once, and
    only those of the ranges that hold a wanted place. Places beyond the table give no rows.
    """
    names, order = plain_order(df, order_by), total_order(df, order_by)
    pieces = _pieces(df, names, order, start, end) if names else [_sorted(df, order, start, end)]
    return reduce(DataFrame.unionByName, pieces) if pieces else df.limit(0)


def _sorted(df: DataFrame, order: Sequence[str], start: int, end: int) -> DataFrame:
    return df.orderBy(*[F.col(f"`{n}`") for n in order]).offset(start).limit(end - start)


def _pieces(df: DataFrame, names: Sequence[str], order: Sequence[str], start: int, end: int) -> list[DataFrame]:
    cuts = [_literal(df, names, row) for row in bounds(df, names)]
    ranged = df.withColumn("_range", range_number(_place(df, names), cuts))
    # One row for each range: two more than twice the bounds at most.
    counts = {r["_range"]: r.n for r in ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    out, before = [], 0
    for number in sorted(counts):
        n = counts[number]
        first, last = max(start - before, 0), min(end - before, n)
        if first < last:
            mine = ranged.where(F.col("_range") == number).drop("_range")
            alike = number % 2 == 1
            if alike and names == order:
                out.append(mine.limit(last - first))
            elif alike or n <= SORTED_ROWS or n == sum(counts.values()):
                out.append(_sorted(mine, order, first, last))
            else:
                out += _pieces(mine, names, order, first, last)
        before += n
    return out
