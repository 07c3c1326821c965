"""Whole jobs: table -> staging -> export -> file -> checks, and file -> table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehandoff.operators import assertions, contract, rows
from tablehandoff.sinks import files as file_sinks
from tablehandoff.sinks import tables
from tablehandoff.sources import files as file_sources
from tablehandoff.sources.files import FixedColumn


class VerificationError(RuntimeError):
    """A delivered file failed a check; staging table and files stay for inspection."""


class ContractError(ValueError):
    """Rows of an inbound file break the contract; nothing was written.

    The message names the most frequent problems, ``problems`` (message, n) has them all.
    """


def staging_join(
    master: DataFrame,
    detail: DataFrame,
    on: tuple[str, str],
    where: Column,
    columns: Sequence[str],
) -> DataFrame:
    """Inner join of master and filtered detail rows; the filter reaches the scan.

    The join strategy is left to the optimizer: a small master is broadcast by its
    measured size, otherwise a hot key is split by skew handling.
    """
    active = detail.where(where)
    return master.join(active, F.col(on[0]) == F.col(on[1])).select(*columns)


@dataclass(frozen=True)
class DownloadJob:
    name: str
    load: DataFrame
    columns: Sequence[str]
    order_by: Sequence[str]
    directory: str
    pattern: str
    run_date: date
    staging_folder: str
    fmt: str = "csv"
    dates_as: Mapping[str, str] = field(default_factory=dict)
    layout: Sequence[FixedColumn] = ()
    row_tag: str = "row"
    root_tag: str = "rows"
    header: str | None = None
    not_null: Sequence[str] = ()
    golden: DataFrame | None = None
    rows_per_file: int | None = None


@dataclass(frozen=True)
class Delivery:
    staging: DataFrame
    files: list[str]
    delivered: DataFrame
    checks: DataFrame
    passed: bool


def deliver(df: DataFrame, job: DownloadJob) -> list[str]:
    common = (job.directory, job.pattern, job.run_date, job.order_by)
    size = job.rows_per_file
    if job.fmt == "csv":
        return file_sinks.deliver_csv(df, *common, rows_per_file=size)
    if job.fmt == "json":
        return file_sinks.deliver_json(df, *common, rows_per_file=size)
    if job.fmt == "xml":
        return file_sinks.deliver_xml(
            df, *common, row_tag=job.row_tag, root_tag=job.root_tag, rows_per_file=size
        )
    if job.fmt == "fixed":
        return file_sinks.deliver_fixed(df, job.layout, *common, rows_per_file=size)
    raise ValueError(f"unknown file format '{job.fmt}'")


def run_download(job: DownloadJob, strict: bool = True) -> Delivery:
    """Stage, export, deliver, verify, in that order.

    A failed check is an error (or with ``strict=False`` a result); what was staged and
    delivered before stays.
    """
    spark = job.load.sparkSession
    staging = tables.refresh_staging(job.load, job.name, job.staging_folder)
    # Delivery sorts into files itself, so the export is only projected here.
    extract = staging.select(*rows.export_columns(job.columns, job.dates_as))
    paths = deliver(extract, job)
    delivered = file_sources.read_format(
        spark, paths, job.fmt, extract.schema, job.row_tag, job.layout
    )
    checks = [assertions.assert_rows(delivered, staging, job.not_null)]
    if job.header is not None:
        checks.append(assertions.assert_header(spark, paths, job.header))
    if job.golden is not None:
        checks.append(
            assertions.assert_golden(delivered, job.golden, list(job.columns), list(job.order_by))
        )
    results = assertions.run_assertions(checks)
    # One row per assertion.
    outcome = results.collect()
    failed = [f"{r.assertion}: {r.detail}" for r in outcome if not r.passed]
    done = Delivery(
        staging, paths, delivered, spark.createDataFrame(outcome, results.schema), not failed
    )
    if failed and strict:
        error = VerificationError(f"{job.name}: " + "; ".join(failed))
        error.delivery = done
        raise error
    return done


def run_upload(
    spark: SparkSession,
    paths: str | list[str],
    fmt: str,
    schema,
    job_name: str,
    target: str,
    batch: str,
    rules: Callable[[], Sequence[contract.Rule | contract.ListRule]] | None = None,
    row_tag: str = "row",
    layout: Sequence[FixedColumn] = (),
    header: bool = True,
) -> DataFrame:
    """Parse a file, check its rows, append them to the job's staging table.

    The rows are checked before anything is written: a record that does not parse and a
    row that breaks a rule are errors. A repeated ``batch`` replaces its own rows. Returns
    the staging table.
    """
    parsed = file_sources.read_format(
        spark, paths, fmt, schema, row_tag, layout, header, keep_corrupt=True, check_header=header
    )
    readable = contract.Rule(~file_sources.corrupt(parsed), F.lit("record does not parse"))
    checks = [readable, *(rules() if rules else [])]
    broken = contract.error_rows(contract.check_rules(parsed, [], checks), [])
    problems = broken.groupBy("message").agg(F.count(F.lit(1)).alias("n"))
    frequent = problems.orderBy(F.desc("n"), "message").limit(20).collect()
    if frequent:
        error = ContractError(
            f"{job_name}: " + "; ".join(f"{r.message} ({r.n} rows)" for r in frequent)
        )
        error.problems = problems
        raise error
    table = f"{target.rstrip('/')}/{tables.staging_name(job_name)}"
    tables.append_history(parsed.drop(file_sources.CORRUPT), table, batch)
    return spark.read.parquet(table).drop("batch")
