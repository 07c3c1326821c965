"""Projections, filters and order: what a single table goes through."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehandoff.functions import dates, text
from tablehandoff.scale import bounded, with_position
from tablehandoff.selection import rows_between


def export(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    dates_as: Mapping[str, str] | None = None,
) -> DataFrame:
    """Exactly ``columns`` in that order, sorted; ``dates_as`` maps a column to a date mask.

    The other columns break ties, so equal sort keys give the same file every time.
    """
    rest = [c for c in columns if c not in order_by]
    return df.select(*export_columns(columns, dates_as)).orderBy(*order_by, *rest)


def export_columns(
    columns: Sequence[str], dates_as: Mapping[str, str] | None = None
) -> list[Column]:
    masks = dates_as or {}
    return [
        dates.format_date(F.col(c), masks[c]).alias(c) if c in masks else F.col(c)
        for c in columns
    ]


class MappingError(ValueError):
    """A field map names fields the table does not have."""


def apply_field_map(df: DataFrame, mapping: DataFrame, max_fields: int = 10_000) -> DataFrame:
    """Columns chosen, ordered and renamed by a (source, target) table.

    The map describes columns, so it is bounded by the width of a table; it is read to
    the driver because the result's columns follow from it.
    """
    seq = ["seq"] if "seq" in mapping.columns else []
    pairs = bounded(mapping.select("source", "target", *seq), max_fields)
    if pairs is None:
        raise MappingError(f"the field map has more than {max_fields} rows")
    if seq:
        pairs = sorted(pairs, key=lambda r: r.seq)
    unknown = sorted({r.source for r in pairs} - set(df.columns))
    if unknown:
        raise MappingError(f"unknown source fields: {unknown} (known: {sorted(df.columns)})")
    return df.select(*[F.col(f"`{r.source}`").alias(r.target) for r in pairs])


def parse_change_log(df: DataFrame, line: str, *keep: str) -> DataFrame:
    """(status, path, old_path) of tab-separated change lines; blank lines are dropped."""
    c = F.col(line)
    return df.where(text.strip(c) != "").select(
        *keep,
        text.change_status(c).alias("status"),
        text.change_path(c).alias("path"),
        text.change_old_path(c).alias("old_path"),
    )


def drop_deletes(changes: DataFrame, status: str = "status") -> DataFrame:
    return changes.where(F.col(status) != "D")


def external_changes(
    changes: DataFrame,
    paths: str,
    message: str,
    prefix: str,
    own_marker: str,
    manual: Column | None = None,
) -> DataFrame:
    """Changes that touch a path below ``prefix`` and are not the pipeline's own work.

    Two guards against a loop: the path filter and the marker in the message; a change
    raised by hand passes both.
    """
    touches = F.exists(paths, lambda p: F.startswith(p, F.lit(prefix)))
    foreign = ~F.contains(F.coalesce(message, F.lit("")), F.lit(own_marker))
    by_hand = F.lit(False) if manual is None else F.coalesce(manual, F.lit(False))
    return changes.where((touches & foreign) | by_hand)


def paginate(
    df: DataFrame, order_by: Sequence[str], page_size: int, name: str = "page"
) -> DataFrame:
    """Adds the 1-based page of every row in the total order."""
    placed = with_position(df, order_by, "_position")
    page = F.floor(F.col("_position") / page_size) + 1
    return placed.withColumn(name, page.cast("long")).drop("_position")


def page(df: DataFrame, order_by: Sequence[str], number: int, page_size: int) -> DataFrame:
    """One page of the total order, by position: only the ranges that hold it are sorted."""
    if number < 1 or page_size < 1:
        raise ValueError("page and page size start at 1")
    return rows_between(df, order_by, (number - 1) * page_size, number * page_size)


class UnknownNames(ValueError):
    """Requested names that are not in the canonical list."""


def canonical_order(df: DataFrame, name: str, ordinals: Sequence[str]) -> DataFrame:
    """Adds ``ordinal`` (1-based place in the canonical list) and sorts by it.

    Names outside the list are rejected together, sorted.
    """
    known = F.array(*[F.lit(n) for n in ordinals])
    unknown = bounded(df.where(~F.col(name).isin(list(ordinals))).select(name).distinct())
    if unknown is None:
        raise UnknownNames(f"too many unknown names to list; valid: {list(ordinals)}")
    if unknown:
        names = sorted(r[0] for r in unknown)
        raise UnknownNames(f"unknown names: {names}; valid: {list(ordinals)}")
    return df.withColumn("ordinal", F.array_position(known, F.col(name)).cast("long")).orderBy(
        "ordinal"
    )


def head_rows(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def sample_lines(
    lines: DataFrame, n: int = text.SAMPLE_LINES, file: str = "file", order: str = "line_no"
) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` lines of every file, and (file, total, truncated) of every file.

    Lines are rows here, so a file may be of any size: a map task passes on at most ``n``
    lines of a file, and the totals are counts.
    """
    rank = F.row_number().over(Window.partitionBy(file).orderBy(order))
    head = lines.withColumn("_rank", rank).where(F.col("_rank") <= n)
    totals = lines.groupBy(file).agg(F.count(F.lit(1)).alias("total"))
    return (
        head.withColumn(order, F.col("_rank").cast("long")).drop("_rank"),
        totals.withColumn("truncated", F.col("total") > n),
    )


def markdown_rows(df: DataFrame, columns: Sequence[str], name: str = "line") -> DataFrame:
    return df.withColumn(name, text.markdown_row([F.col(c) for c in columns]))


def markdown_table(df: DataFrame, title: str, columns: Sequence[str], seq: str) -> DataFrame:
    """(seq, line) of the table under its title; a table without rows gives no lines.

    The heading takes the places before the first row and exists only with it: it is an
    aggregate over the rows that yields nothing for an empty table.
    """
    body = df.select(
        F.col(seq).cast("long").alias("seq"),
        text.markdown_row([F.col(c) for c in columns]).alias("line"),
    )
    heading = [
        f"### Sheet: {title}",
        "| " + " | ".join(columns) + " |",
        "|" + "---|" * len(columns),
    ]
    head = (
        df.agg(F.min(F.col(seq).cast("long")).alias("_first"))
        .where(F.col("_first").isNotNull())
        .select("_first", F.posexplode(F.array(*[F.lit(h) for h in heading])).alias("_i", "line"))
        .select((F.col("_first") - len(heading) + F.col("_i")).alias("seq"), "line")
    )
    return head.unionByName(body).orderBy("seq")
