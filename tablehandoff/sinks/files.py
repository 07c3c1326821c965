"""Delivery of an export as named csv, fixed-width, json or xml files."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from tablehandoff.functions.dates import resolve_file_name
from tablehandoff import storage
from tablehandoff.scale import with_position
from tablehandoff.sinks import versions
from tablehandoff.sources.files import FixedColumn

# Files and rows that one task writes, where files are small.
TASK_FILES, TASK_ROWS = 200, 100_000
_PART = re.compile(r"part-(\d+)-.*-c(\d+)(\.|$)")


class LayoutError(ValueError):
    """A value does not fit its fixed-width column."""


def ordered_parts(
    df: DataFrame, order_by: Sequence[str], rows: int | None, rows_per_file: int | None
) -> DataFrame:
    """``df`` in sorted partitions, each for one file or several; partition i sorts before i + 1.

    Remaining columns break ties. Exact copies of a row are told apart by the row id of
    the scan, so that even a third of the table being one row spreads over the files.

    Every task reports to the driver, and every range is drawn from rows sampled there. So a
    task writes several small files: its rows are those of whole files, by their exact position,
    and the writer begins a file after each ``rows_per_file`` of them. Large files are ranges.
    """
    order = [*order_by, *[c for c in df.columns if c not in order_by]]
    parts = 1 if rows_per_file is None else max(1, math.ceil(rows / rows_per_file))
    if parts == 1:
        return df.repartition(1).sortWithinPartitions(*order)
    if rows_per_file >= TASK_ROWS:
        return (
            df.withColumn("_copy", F.monotonically_increasing_id())
            .repartitionByRange(parts, *order, "_copy")
            .sortWithinPartitions(*order)
            .drop("_copy")
        )
    most = min(TASK_FILES, math.ceil(TASK_ROWS / rows_per_file))
    tasks = max(math.ceil(parts / most), min(parts, df.sparkSession.sparkContext.defaultParallelism))
    task_rows = math.ceil(parts / tasks) * rows_per_file
    tasks = math.ceil(rows / task_rows)
    task = F.least(F.floor(F.col("_position") / task_rows), F.lit(tasks - 1)).cast("int")
    return (
        with_position(df, order_by, "_position")
        .repartitionById(tasks, task)
        .sortWithinPartitions("_position")
        .drop("_position")
    )


def part_order(name: str) -> tuple[int, int]:
    """The place of a part file: task, then file of the task. By number, not as text:
    part-100000 comes after part-99999."""
    found = _PART.match(name)
    return int(found[1]), int(found[2])


def publish(
    df: DataFrame, staged: str, directory: str, name: str, numbered: bool
) -> list[str]:
    """Moves the part files in ``staged`` to their final names and returns those.

    The caller decides the names, never the number of rows: ``name`` itself for the only
    part, or if ``numbered`` ``stem-00000.ext`` and so on, also for a single part. Files of
    an earlier delivery under the same name that are no longer part of it are removed.
    """
    spark = df.sparkSession
    base = directory.rstrip("/")
    storage.make_folder(spark, base)
    parts = sorted(
        (f for f in storage.file_names(spark, staged) if f.startswith("part-")), key=part_order
    )
    stem, dot, ext = name.rpartition(".")
    if not dot:
        stem, ext = name, ""
    names = (
        [f"{stem}-{i:05d}{dot}{ext}" for i in range(len(parts))] if numbered else [name]
    )
    with ThreadPoolExecutor(16) as pool:
        moves = zip(parts, names)
        list(pool.map(lambda m: storage.move(spark, f"{staged}/{m[0]}", f"{base}/{m[1]}"), moves))
    own = re.compile(re.escape(stem) + r"(-\d{5,})?" + re.escape(dot + ext))
    for old in storage.file_names(spark, base):
        if own.fullmatch(old) and old not in names:
            storage.delete(spark, f"{base}/{old}")
    storage.delete(spark, staged)
    return [f"{base}/{n}" for n in names]


def _rows(df: DataFrame, rows_per_file: int | None) -> int | None:
    """The number of rows if the number of files depends on it."""
    return None if rows_per_file is None else df.count()


def _staged(directory: str) -> str:
    return f"{directory.rstrip('/')}/.incoming-{uuid.uuid4().hex}"


def _cut(rows_per_file: int | None) -> int:
    """After how many rows the writer begins a new file; 0 is never."""
    return 0 if rows_per_file is None or rows_per_file >= TASK_ROWS else rows_per_file


def _writer(parts: DataFrame, rows_per_file: int | None) -> DataFrameWriter:
    return parts.write.option("maxRecordsPerFile", _cut(rows_per_file))


def _lines(df: DataFrame) -> int:
    """The number of rows; an error if a value holds a line break."""
    texts = [f.name for f in df.schema if f.dataType.typeName() in ("string", "varchar", "char")]
    broken = [F.count_if(F.col(c).rlike(r"[\r\n]")).alias(c) for c in texts]
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *broken).first()
    wrong = [f"{c}: {counted[c]} rows" for c in texts if counted[c]]
    if wrong:
        raise LayoutError("values hold line breaks (" + ", ".join(wrong) + ")")
    return counted["_rows"]


def deliver_version(
    df: DataFrame, directory: str, fmt: str, order_by: Sequence[str], rows_per_file: int, **options: object
) -> versions.Pointer:
    """All files of a delivery as one version of ``directory``, current from one rename on.

    For deliveries of many files: nothing is done file by file, and whoever reads the current
    version gets the files of one delivery, never some of two. Files keep the names of the
    writer, whose order is that of the rows; the pointer records how many rows they hold.
    """
    spark, base = df.sparkSession, directory.rstrip("/")
    rows = _lines(df) if fmt == "csv" else df.count()
    parts = ordered_parts(df, order_by, rows, rows_per_file)
    if fmt == "csv":
        options = {"header": True, "escape": '"'} | options
    options = {"maxRecordsPerFile": _cut(rows_per_file)} | options
    pointer = versions.publish(spark, base, versions.write_version(parts, base, fmt, **options), str(rows))
    versions.clean(spark, base)
    return pointer


def deliver_csv(
    df: DataFrame,
    directory: str,
    pattern: str,
    run_date: date,
    order_by: Sequence[str],
    rows_per_file: int | None = None,
    sep: str = ",",
) -> list[str]:
    """Header plus rows in export order; zero rows still give a file with the header.

    Without ``rows_per_file`` one file of the agreed name, written by one task; with it
    numbered files. A value with a line break is an error: readers take a line for a row.
    """
    staged = _staged(directory)
    parts = ordered_parts(df, order_by, _lines(df), rows_per_file)
    _writer(parts, rows_per_file).option("header", True).option("sep", sep).option("escape", '"').csv(staged)
    return publish(df, staged, directory, resolve_file_name(pattern, run_date), rows_per_file is not None)


def fixed_line(layout: Sequence[FixedColumn]) -> Column:
    cells = []
    for col in layout:
        value = F.coalesce(F.col(col.name).cast("string"), F.lit(""))
        pad = F.rpad if col.align == "left" else F.lpad
        cell = pad(value, col.width, col.pad)
        if col.pad == "0" and col.align != "left" and col.type != "string":
            # Zeros alone are the number zero; a missing number is blank.
            cell = F.when(F.col(col.name).isNull(), F.lit(" " * col.width)).otherwise(cell)
        cells.append(cell)
    return F.concat(*cells)


def misfit(layout: Sequence[FixedColumn]) -> dict[str, Column]:
    """Per column: the value is too long or holds a line break (padding would cut it)."""
    out = {}
    for col in layout:
        value = F.col(col.name).cast("string")
        out[col.name] = F.coalesce(
            (F.length(value) > col.width) | value.rlike(r"[\r\n]"), F.lit(False)
        )
    return out


def deliver_fixed(
    df: DataFrame,
    layout: Sequence[FixedColumn],
    directory: str,
    pattern: str,
    run_date: date,
    order_by: Sequence[str],
    rows_per_file: int | None = None,
) -> list[str]:
    bad = misfit(layout)
    checks = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(expr).alias(name) for name, expr in bad.items()],
    ).first()
    wrong = [f"{name}: {checks[name]} rows" for name in bad if checks[name]]
    if wrong:
        raise LayoutError("values do not fit the layout (" + ", ".join(wrong) + ")")
    staged = _staged(directory)
    parts = ordered_parts(df, order_by, checks["_rows"], rows_per_file)
    _writer(parts.select(fixed_line(layout).alias("value")), rows_per_file).text(staged)
    return publish(df, staged, directory, resolve_file_name(pattern, run_date), rows_per_file is not None)


def deliver_json(
    df: DataFrame,
    directory: str,
    pattern: str,
    run_date: date,
    order_by: Sequence[str],
    rows_per_file: int | None = None,
) -> list[str]:
    """One object per line, null fields written out."""
    staged = _staged(directory)
    parts = ordered_parts(df, order_by, _rows(df, rows_per_file), rows_per_file)
    _writer(parts, rows_per_file).option("ignoreNullFields", False).json(staged)
    return publish(df, staged, directory, resolve_file_name(pattern, run_date), rows_per_file is not None)


def deliver_xml(
    df: DataFrame,
    directory: str,
    pattern: str,
    run_date: date,
    order_by: Sequence[str],
    row_tag: str,
    root_tag: str,
    rows_per_file: int | None = None,
) -> list[str]:
    staged = _staged(directory)
    parts = ordered_parts(df, order_by, _rows(df, rows_per_file), rows_per_file)
    _writer(parts, rows_per_file).format("xml").option("rowTag", row_tag).option("rootTag", root_tag).save(staged)
    return publish(df, staged, directory, resolve_file_name(pattern, run_date), rows_per_file is not None)


def any_misfit(layout: Sequence[FixedColumn]) -> Column:
    return reduce(lambda a, b: a | b, misfit(layout).values())
