"""The run report as ordered text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehandoff.functions import text
from tablehandoff import storage

# Wording of the report.
LOW_CONFIDENCE = "**⚠ assertions are AI-authored — lower confidence**"
PASS_LINE, FAIL_LINE = "**Result: ✅ PASS**", "**Result: ❌ FAIL**"


def _rows(df: DataFrame, section: int, seq: Column, line: Column) -> DataFrame:
    return df.select("job", F.lit(section).alias("section"), seq.cast("long").alias("seq"), line.alias("line"))


def _fixed(df: DataFrame, section: int, *lines: Column) -> DataFrame:
    pairs = F.posexplode(F.array(*lines)).alias("seq", "line")
    return df.select("job", F.lit(section).alias("section"), pairs).select(
        "job", "section", F.col("seq").cast("long").alias("seq"), "line"
    )


WARNING = "- ⚠ "


def report_lines(
    jobs: DataFrame, items: DataFrame, warnings: DataFrame, output: DataFrame, runs: DataFrame | None = None
) -> DataFrame:
    """(job, section, seq, line), one report per job.

    jobs(job, passed, confident) · items(job, seq, item, path, generated_at) ·
    warnings(job, seq, message) · output(job, text) · runs(job, url), the link to the run of a
    job. Headings without content, the banner of a confident job and the link of a run without
    an address are left out.
    """
    title = F.concat(F.lit("# Run report — "), F.col("job"))
    verdict = F.when(F.col("passed"), PASS_LINE).otherwise(FAIL_LINE)
    item = F.format_string("- %s: `%s` (generated %s)", "item", "path", "generated_at")
    lines = (
        _fixed(jobs, 0, title, F.lit(""))
        .unionByName(_fixed(jobs.where(~F.col("confident")), 1, F.lit(LOW_CONFIDENCE), F.lit("")))
        .unionByName(_fixed(jobs, 2, verdict, F.lit(""), F.lit("## Artifacts")))
        .unionByName(_rows(items, 3, F.col("seq"), item))
        .unionByName(
            _fixed(warnings.select("job").distinct(), 4, F.lit(""), F.lit("## Validation warnings"))
        )
        .unionByName(_rows(warnings, 5, F.col("seq"), F.concat(F.lit(WARNING), "message")))
        .unionByName(
            _fixed(
                output, 6, F.lit(""), F.lit("## Test output"), F.lit("```"),
                text.tail_chars(F.col("text")), F.lit("```"),
            )
        )
    )
    if runs is None:
        return lines
    linked = runs.where(F.coalesce("url", F.lit("")) != "")
    return lines.unionByName(_fixed(linked, 7, F.lit(""), F.format_string("[Workflow run](%s)", "url")))


def warning_report(warnings: DataFrame) -> DataFrame:
    """(job, section, seq, line): the warnings of a validation as a report of their own, for
    each job that has any. warnings(job, seq, message)."""
    return _fixed(warnings.select("job").distinct(), 0, F.lit("# Validation warnings"), F.lit("")).unionByName(
        _rows(warnings, 1, F.col("seq"), F.concat(F.lit(WARNING), "message"))
    )


def write_report(lines: DataFrame, path: str) -> None:
    """Text files per job below ``path`` (``job=<name>/``), replaced job by job.

    Usually one file; the range partitioning lets a very long report span several files
    whose name order is the line order.
    """
    storage.make_folder(lines.sparkSession, path)
    (
        lines.repartitionByRange("job", "section", "seq")
        .sortWithinPartitions("job", "section", "seq")
        .select("job", "line")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("job")
        .text(path)
    )
