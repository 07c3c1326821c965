"""File sources: delivered formats, text corpora and directory listings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehandoff import storage
from tablehandoff.functions import text

PLACEHOLDER = ".gitkeep"
CORRUPT = "_corrupt"


@dataclass(frozen=True)
class FixedColumn:
    """One column of a fixed-width layout."""

    name: str
    width: int
    type: str = "string"
    align: str = "left"
    pad: str = " "


def _with_corrupt(schema: T.StructType, keep: bool) -> T.StructType:
    return schema.add(CORRUPT, T.StringType()) if keep else schema


def _schema(schema: str | T.StructType) -> T.StructType:
    if isinstance(schema, str):
        return T.StructType.fromDDL(schema)
    return T.StructType(list(schema.fields))


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType,
    header: bool = True,
    sep: str = ",",
    multiline: bool = False,
    keep_corrupt: bool = False,
    check_header: bool = False,
) -> DataFrame:
    """Rows of a delimited file. ``multiline`` allows line breaks inside quoted values,
    at the price of reading every file in one task; ``check_header`` makes a header that
    does not name the columns an error."""
    return (
        spark.read.schema(_with_corrupt(_schema(schema), keep_corrupt))
        .option("header", header)
        .option("sep", sep)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("enforceSchema", not check_header)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def parse_fixed(line: Column, layout: Sequence[FixedColumn]) -> list[Column]:
    """The typed cells of a line, then ``_corrupt``: the line itself if it does not fit the
    layout (wrong width, or a cell that is not of its type)."""
    cells, wrong, start = [], F.length(line) != sum(c.width for c in layout), 1
    for col in layout:
        raw = F.substring(line, start, col.width)
        cut = F.rtrim(raw, F.lit(col.pad)) if col.align == "left" else F.ltrim(raw, F.lit(col.pad))
        text_cell = F.nullif(cut, F.lit(""))
        if col.pad == "0" and col.align != "left" and col.type != "string":
            # Nothing but zeros is the number zero; null is written as blanks.
            text_cell = F.when((cut == "") & (raw != ""), F.lit("0")).otherwise(F.nullif(F.trim(cut), F.lit("")))
        cell = text_cell.try_cast(col.type)
        wrong = wrong | (text_cell.isNotNull() & cell.isNull())
        cells.append(cell.alias(col.name))
        start += col.width
    return [*cells, F.when(wrong, line).alias(CORRUPT)]


def read_fixed(
    spark: SparkSession,
    path: str | list[str],
    layout: Sequence[FixedColumn],
    keep_corrupt: bool = False,
) -> DataFrame:
    rows = spark.read.text(path).select(*parse_fixed(F.col("value"), layout))
    return rows if keep_corrupt else rows.drop(CORRUPT)


def corrupt(df: DataFrame) -> Column:
    """The record of this row did not parse (``df`` read with ``keep_corrupt``).

    The values take part as a zero: a reader parses only the columns that are used.
    """
    values = F.xxhash64(*[c for c in df.columns if c != CORRUPT])
    return F.col(CORRUPT).isNotNull() & (F.pmod(values, F.lit(1)) == 0)


def read_json_file(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType,
    keep_corrupt: bool = False,
) -> DataFrame:
    return (
        spark.read.schema(_with_corrupt(_schema(schema), keep_corrupt))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_xml_file(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType,
    row_tag: str,
    keep_corrupt: bool = False,
) -> DataFrame:
    return (
        spark.read.format("xml")
        .schema(_with_corrupt(_schema(schema), keep_corrupt))
        .option("rowTag", row_tag)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .load(path)
    )


def read_format(
    spark: SparkSession,
    paths: str | list[str],
    fmt: str,
    schema: str | T.StructType | None = None,
    row_tag: str = "row",
    layout: Sequence[FixedColumn] = (),
    header: bool = True,
    keep_corrupt: bool = False,
    check_header: bool = False,
) -> DataFrame:
    """Rows of files in one of the delivery formats."""
    if fmt == "csv":
        return read_delimited(
            spark, paths, schema, header, keep_corrupt=keep_corrupt, check_header=check_header
        )
    if fmt == "json":
        return read_json_file(spark, paths, schema, keep_corrupt)
    if fmt == "xml":
        return read_xml_file(spark, paths, schema, row_tag, keep_corrupt)
    if fmt == "fixed":
        return read_fixed(spark, paths, layout, keep_corrupt)
    raise ValueError(f"unknown file format '{fmt}'")


def _relative(path: Column, root: str) -> Column:
    """Path below ``root``; the scheme in front (``file:``, ``hdfs://host``) may differ."""
    clean = F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), r"^[a-z0-9]+:(//[^/]*)?", "")
    base = root.split("://", 1)[-1] if "://" in root else root.removeprefix("file:")
    if "://" in root:
        base = "/" + base.split("/", 1)[1]
    return F.regexp_replace(F.replace(clean, F.lit(base.rstrip("/") + "/"), F.lit("/")), "^/+", "")


def _base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def read_corpus(spark: SparkSession, root: str) -> DataFrame:
    """(path, text) of every non-empty file below ``root``, text stripped."""
    raw = (
        spark.read.text(root, wholetext=True, recursiveFileLookup=True)
        .select(
            _relative(F.col("_metadata.file_path"), root).alias("path"),
            text.strip(F.col("value")).alias("text"),
        )
    )
    return raw.where((_base_name(F.col("path")) != PLACEHOLDER) & (F.col("text") != ""))


def list_inventory(
    spark: SparkSession, root: str, top_dirs: Sequence[str] | None = None
) -> DataFrame:
    """(top, rel_path, size, mtime) of the files below ``root``; no content is read.

    A scan skips files without content, so these are added from the file index of the
    scan (size 0, mtime unknown).
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    files = listed.select(
        _relative(F.col("path"), root).alias("rel_path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("mtime"),
    )
    # One string, since the index already holds every path on the driver.
    names = spark._jvm.org.apache.hadoop.util.StringUtils.join("\n", listed._jdf.inputFiles())
    index = spark.createDataFrame([(n,) for n in names.split("\n") if n], "path string")
    empty = index.select(_relative(F.col("path"), root).alias("rel_path")).join(
        files.select("rel_path"), "rel_path", "left_anti"
    )
    files = files.unionByName(
        empty.select(
            "rel_path", F.lit(0).cast("long").alias("size"),
            F.lit(None).cast("timestamp").alias("mtime"),
        )
    )
    files = files.withColumn("top", F.split("rel_path", "/")[0]).where(
        _base_name(F.col("rel_path")) != PLACEHOLDER
    )
    if top_dirs is not None:
        files = files.where(F.col("top").isin(list(top_dirs)) & F.contains("rel_path", F.lit("/")))
    return files.select("top", "rel_path", "size", "mtime")


def landing_lookup(spark: SparkSession, directory: str, prefix: str) -> str | None:
    """Full path of the first file (by name) in ``directory`` that starts with ``prefix``.

    A directory entry is enough: the file may be empty.
    """
    names = storage.matching_files(spark, directory, prefix)
    return f"{directory.rstrip('/')}/{names[0]}" if names else None


def first_matches(files: DataFrame, prefixes: DataFrame, name: str = "name", prefix: str = "prefix") -> DataFrame:
    """(prefix, name): for each prefix the first file name, by name, that starts with it, null
    if there is none. The lookup of ``landing_lookup`` for many prefixes over a listing.

    A name is matched by its own starts of the lengths that prefixes have, so the join is on
    equal texts; an empty prefix matches every name.
    """
    wanted = prefixes.select(F.col(prefix).alias("prefix")).where(F.col("prefix").isNotNull()).distinct()
    # File names have 255 bytes at most; longer prefixes match none.
    lengths = [r.n for r in wanted.select(F.length("prefix").alias("n")).where("n <= 255").distinct().collect()]
    starts = F.array(*[F.when(F.length(name) >= n, F.left(name, F.lit(n))) for n in sorted(lengths)])
    named = files.select(F.col(name).alias("name"), F.explode(F.array_compact(starts.cast("array<string>"))).alias("prefix"))
    first = named.groupBy("prefix").agg(F.min("name").alias("name"))
    return wanted.join(first, "prefix", "left").select("prefix", "name")


def file_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line_no, line) in file order; line_no starts at 1 and only orders the lines.

    A file is read in splits; the block start orders them and the row id orders the lines
    inside, so the numbers increase along the file but are not gap-free.
    """
    return (
        spark.read.text(path)
        .select(
            _base_name(F.col("_metadata.file_path")).alias("file"),
            (F.col("_metadata.file_block_start")).alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
            F.col("value").alias("line"),
        )
        .select("file", F.struct("_block", "_row").alias("line_no"), "line")
    )
