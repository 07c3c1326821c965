"""Relational sources described by connection metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession


def jdbc_url(meta: Mapping[str, Any]) -> str:
    """``sid`` names the legacy identifier and wins, ``service`` the service name."""
    if meta.get("url"):
        return meta["url"]
    host, port = meta["host"], int(meta["port"])
    if meta.get("sid"):
        return f"jdbc:oracle:thin:@{host}:{port}:{meta['sid']}"
    if meta.get("service"):
        return f"jdbc:oracle:thin:@//{host}:{port}/{meta['service']}"
    raise KeyError("the connection must define either 'service' or 'sid'")


def read_options(
    meta: Mapping[str, Any],
    table_or_query: str,
    key: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of the JDBC reader; with ``key`` and ``bounds`` it reads in parallel ranges."""
    is_query = table_or_query.lstrip().lower().startswith(("select ", "select\n", "with "))
    options = {
        "url": jdbc_url(meta),
        "dbtable": f"({table_or_query}) q" if is_query else table_or_query,
        "fetchsize": str(fetch_size),
    }
    for name in ("driver", "user", "password"):
        if meta.get(name):
            options[name] = str(meta[name])
    if partitions > 1:
        if key is None or bounds is None:
            raise ValueError("parallel reads need a key column and its bounds")
        options |= {
            "partitionColumn": key,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


class Cell(NamedTuple):
    """A cell of a key histogram: the least and largest key in it, and its rows."""

    low: Any
    high: Any
    rows: int


def histogram_query(table_or_query: str, key: str, low: Any, high: Any, cells: int) -> str:
    """SQL for the histogram of a numeric key: (low, high, rows) of the filled cells, by key."""
    width = (float(high) - float(low) + 1) / cells
    cell = f"floor(({key} - ({low})) / {width!r})"
    return (
        f"select min({key}) as low, max({key}) as high, count(*) as n from ({_inner(table_or_query)}) t "
        f"where {key} is not null group by {cell} order by 1"
    )


def range_predicates(key: str, cells: Sequence[Cell], partitions: int, spread: str | None = None) -> list[str]:
    """Conditions, one for each task, that share out all rows of the source.

    Ranges of the key hold about equal numbers of rows, whatever its distribution: they end
    where the histogram reaches the next share. A cell with one key value and several shares of
    rows cannot be cut by the key; ``spread``, an expression with whole numbers of zero or more,
    shares out its rows by remainder. Null keys are a task of their own.
    """
    total = sum(c.rows for c in cells)
    share = max(1, -(-total // max(1, partitions)))
    groups: list[list[Cell]] = []
    for cell in sorted(cells, key=lambda c: c.low):
        if groups and sum(c.rows for c in groups[-1]) + cell.rows <= share:
            groups[-1].append(cell)
        else:
            groups.append([cell])
    out = []
    for n, group in enumerate(groups):
        first, last = group[0], group[-1]
        lower = f"{key} >= {sql_value(first.low)}" if n else None
        upper = f"{key} < {sql_value(groups[n + 1][0].low)}" if n + 1 < len(groups) else None
        within = " and ".join(x for x in (lower, upper) if x) or f"{key} is not null"
        parts = -(-first.rows // share) if len(group) == 1 and first.low == last.high and spread else 1
        if parts == 1:
            out.append(within)
        else:
            out += [f"{within} and mod({spread}, {parts}) = {i}" for i in range(parts)]
    return [*out, f"{key} is null"]


def sql_value(value: Any) -> str:
    """A number, date, time or text as an SQL literal."""
    if isinstance(value, bool) or value is None:
        raise TypeError(f"no key: {value!r}")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        return f"timestamp '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"date '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def read_by_histogram(
    spark: SparkSession,
    meta: Mapping[str, Any],
    table_or_query: str,
    key: str,
    partitions: int,
    spread: str | None = None,
    cells: int = 1000,
) -> DataFrame:
    """Rows of a table or query in about ``partitions`` tasks of equal size by a numeric key.

    The source is asked for the extent of the key (one row) and its histogram (``cells`` rows).
    """
    extent = f"select min({key}) as lo, max({key}) as hi from ({_inner(table_or_query)}) t"
    low, high = spark.read.format("jdbc").options(**read_options(meta, extent)).load().first()
    if low is None:
        return read_relational(spark, meta, table_or_query)
    counts = histogram_query(table_or_query, key, low, high, cells)
    held = [Cell(*r) for r in spark.read.format("jdbc").options(**read_options(meta, counts)).load().collect()]
    options = read_options(meta, table_or_query)
    url, table = options.pop("url"), options.pop("dbtable")
    return spark.read.jdbc(url, table, predicates=range_predicates(key, held, partitions, spread), properties=options)


def read_relational(
    spark: SparkSession,
    meta: Mapping[str, Any],
    table_or_query: str,
    key: str | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Rows of a table or query; with ``key``, in ``partitions`` ranges of that column.

    The bounds are asked from the source (one row), filters and columns are pushed down. The
    ranges are equally wide; ``read_by_histogram`` makes them equally full.
    """
    bounds = None
    if key is not None and partitions > 1:
        extent = f"select min({key}) as lo, max({key}) as hi from ({_inner(table_or_query)}) t"
        row = spark.read.format("jdbc").options(**read_options(meta, extent)).load().first()
        if row[0] is None:
            partitions = 1
        else:
            bounds = (row[0], row[1])
    return (
        spark.read.format("jdbc")
        .options(**read_options(meta, table_or_query, key, bounds, partitions))
        .load()
    )


def _inner(table_or_query: str) -> str:
    if table_or_query.lstrip().lower().startswith(("select ", "select\n", "with ")):
        return table_or_query
    return f"select * from {table_or_query}"
