"""Checks on delivered data: one row (assertion, passed, detail) each."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablehandoff import storage
from tablehandoff.sources import files

GOLDEN_ROWS = 5  # fixed value: data rows compared besides the header


def _result(df: DataFrame, name: str, passed: Column, detail: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("assertion"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        detail.alias("detail"),
    )


def row_count_matches(out: DataFrame, staging: DataFrame) -> DataFrame:
    """(delivered, staged, passed): two counts brought together by one more aggregate."""
    counts = out.agg(F.count(F.lit(1)).alias("n"), F.lit("out").alias("side")).unionByName(
        staging.agg(F.count(F.lit(1)).alias("n"), F.lit("staging").alias("side"))
    )
    both = counts.agg(
        F.max(F.when(F.col("side") == "out", F.col("n"))).alias("delivered"),
        F.max(F.when(F.col("side") == "staging", F.col("n"))).alias("staged"),
    )
    return both.withColumn("passed", F.col("delivered") == F.col("staged"))


def assert_row_count(out: DataFrame, staging: DataFrame) -> DataFrame:
    counts = row_count_matches(out, staging)
    detail = F.format_string("delivered %d rows, staged %d", "delivered", "staged")
    return _result(counts, "row count", F.col("passed"), detail)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, nulls) for all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns]
    return counted.select(F.inline(F.array(*cells)))


def assert_no_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One result per column."""
    counted = null_counts(df, columns)
    return counted.select(
        F.concat(F.lit("no null values in "), F.col("column")).alias("assertion"),
        (F.col("nulls") == 0).alias("passed"),
        F.format_string("%d null values", "nulls").alias("detail"),
    )


def assert_rows(out: DataFrame, staging: DataFrame, not_null: Sequence[str] = ()) -> DataFrame:
    """Row count and null checks of a delivery together: the files are read once."""
    nulls = [f"_nulls_{i}" for i in range(len(not_null))]
    none = F.lit(None).cast("long")
    delivered = out.agg(
        F.count(F.lit(1)).alias("delivered"),
        none.alias("staged"),
        *[F.count_if(F.col(c).isNull()).alias(n) for c, n in zip(not_null, nulls)],
    )
    staged = staging.agg(
        none.alias("delivered"), F.count(F.lit(1)).alias("staged"), *[none.alias(n) for n in nulls]
    )
    names = ["delivered", "staged", *nulls]
    both = delivered.unionByName(staged).agg(*[F.max(n).alias(n) for n in names])
    results = [
        F.struct(
            F.lit("row count").alias("assertion"),
            (F.col("delivered") == F.col("staged")).alias("passed"),
            F.format_string("delivered %d rows, staged %d", "delivered", "staged").alias("detail"),
        ),
        *[
            F.struct(
                F.lit(f"no null values in {c}").alias("assertion"),
                (F.col(n) == 0).alias("passed"),
                F.format_string("%d null values", n).alias("detail"),
            )
            for c, n in zip(not_null, nulls)
        ],
    ]
    return both.select(F.inline(F.array(*results)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, rows) of the keys that occur more than once."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counted.where(F.col("rows") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    count = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("n"))
    return _result(
        count,
        f"unique key {', '.join(keys)}",
        F.col("n") == 0,
        F.format_string("%d keys occur more than once", "n"),
    )


def first_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, line): the first line of every file; nothing else of the files is read."""
    every = [paths] if isinstance(paths, str) else paths
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda p: storage.first_line(spark, p), every))
    rows = [(p.rsplit("/", 1)[-1], line) for p, line in zip(every, lines)]
    return spark.createDataFrame(rows, "file string, line string")


def assert_header(spark: SparkSession, path: str | list[str], header: str) -> DataFrame:
    """The first line of every delivered file equals the sample's first line exactly."""
    differs = ~F.col("line").eqNullSafe(F.lit(header))
    wrong = first_lines(spark, path).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(differs).alias("n")
    )
    return _result(
        wrong,
        "header matches the sample",
        (F.col("n") == 0) & (F.col("files") > 0),
        F.format_string("%d of %d files differ", "n", "files"),
    )


def _numbered_head(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], n: int, name: str) -> DataFrame:
    # A top-n; the window then sees n rows.
    head = df.orderBy(*order_by).limit(n)
    return head.select(
        F.row_number().over(Window.orderBy(*order_by)).cast("long").alias("position"),
        F.struct(*columns).alias(name),
    )


def golden_compare(
    actual: DataFrame,
    expected: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    n: int = GOLDEN_ROWS,
) -> DataFrame:
    """(position, matches, differing) over the first ``n`` rows of both sides.

    A row missing on one side does not match; ``differing`` lists the columns.
    """
    left = _numbered_head(actual, columns, order_by, n, "actual")
    right = _numbered_head(expected, columns, order_by, n, "expected")
    both = left.join(right, "position", "full_outer")
    differing = F.array_compact(
        F.array(*[
            F.when(~F.col(f"actual.{c}").eqNullSafe(F.col(f"expected.{c}")), F.lit(c))
            for c in columns
        ])
    )
    present = F.col("actual").isNotNull() & F.col("expected").isNotNull()
    return both.select(
        "position",
        (present & (F.size(differing) == 0)).alias("matches"),
        F.concat_ws(",", differing).alias("differing"),
    )


def assert_golden(
    actual: DataFrame,
    expected: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    n: int = GOLDEN_ROWS,
) -> DataFrame:
    """Same column names in the same order, and the first ``n`` rows equal."""
    if list(actual.columns) != list(expected.columns):
        detail = f"header {actual.columns} instead of {expected.columns}"
        return _result(
            actual.sparkSession.range(1), "golden rows", F.lit(False), F.lit(detail)
        )
    wrong = golden_compare(actual, expected, columns, order_by, n).agg(
        F.count_if(~F.col("matches")).alias("n")
    )
    return _result(
        wrong, "golden rows", F.col("n") == 0, F.format_string("%d rows differ", "n")
    )


def golden_lines(
    actual: DataFrame, expected: DataFrame, n: int = GOLDEN_ROWS + 1
) -> DataFrame:
    """The same comparison for text lines (line_no, line): header and first rows."""
    return golden_compare(
        actual.select("line_no", "line"), expected.select("line_no", "line"), ["line"], ["line_no"], n
    )


def default_checks(
    spark: SparkSession,
    directory: str,
    names: Sequence[str],
    fmt: str,
    schema: str,
    header: str | None = None,
    row_tag: str = "row",
    layout: Sequence[files.FixedColumn] = (),
) -> DataFrame:
    """What is checked without human assertions: the files exist, are not empty, carry the
    sample's header and parse as their format."""
    base = directory.rstrip("/")
    sizes = {n: storage.file_size(spark, f"{base}/{n}") for n in names}
    there = [n for n in names if sizes[n] is not None]
    absent, empty = len(names) - len(there), sum(1 for n in there if not sizes[n])
    one = spark.range(1)
    results = [
        _result(one, "file exists", F.lit(not absent), F.lit(f"{absent} files missing")),
        _result(one, "file is not empty", F.lit(not empty), F.lit(f"{empty} empty files")),
    ]
    paths = [f"{base}/{n}" for n in there]
    if header is not None:
        results.append(assert_header(spark, paths, header))
    results.append(_parses(spark, paths, fmt, schema, row_tag, layout))
    return reduce(DataFrame.unionByName, results)


def _parses(spark, paths, fmt, schema, row_tag, layout) -> DataFrame:
    if not paths:
        return _result(spark.range(1), f"parses as {fmt}", F.lit(False), F.lit("no file to read"))
    rows = files.read_format(spark, paths, fmt, schema, row_tag, layout, keep_corrupt=True)
    counted = rows.agg(F.count_if(files.corrupt(rows)).alias("n"))
    return _result(
        counted, f"parses as {fmt}", F.col("n") == 0, F.format_string("%d bad records", "n")
    )


def confidence_flag(
    jobs: DataFrame, assertions: DataFrame, test_files: DataFrame, key: str = "job"
) -> DataFrame:
    """(key, confident): a person wrote at least one assertion or put a file into tests."""
    human = assertions.select(key).unionByName(test_files.select(key)).distinct()
    marked = human.withColumn("_human", F.lit(True))
    return jobs.select(key).join(marked, key, "left").select(
        key, F.coalesce("_human", F.lit(False)).alias("confident")
    )


def verdict(results: DataFrame, groups: Sequence[str], result: str = "result") -> DataFrame:
    """(groups, passed): no result is ``fail``; an empty result is not a failure."""
    return results.groupBy(*groups).agg(
        F.bool_and(F.coalesce(F.col(result), F.lit("")) != "fail").alias("passed")
    )


def run_assertions(checks: Sequence[DataFrame]) -> DataFrame:
    """All results, one row per assertion."""
    return reduce(DataFrame.unionByName, checks)


def error_summary(errors: DataFrame, keys: Sequence[str], severity: str = "severity") -> DataFrame:
    """(keys, errors, warnings, ok); warnings never fail a job."""
    return errors.groupBy(*keys).agg(
        F.count_if(F.col(severity) == "error").alias("errors"),
        F.count_if(F.col(severity) == "warning").alias("warnings"),
    ).withColumn("ok", F.col("errors") == 0)
