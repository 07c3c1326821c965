"""Whole jobs, assertions and the report."""

import os
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablehandoff.operators import assertions, contract
from tablehandoff.plans.jobs import ContractError, DownloadJob, VerificationError, run_download, run_upload, staging_join
from tablehandoff.sinks import report
from tablehandoff.sources.files import FixedColumn

COLUMNS = ["STUDENT_ID", "FAMILY_NAME", "GIVEN_NAME", "COURSE_CODE", "ENROLLED_DATE"]
GOLDEN = [
    ("S1000001", "Nguyen", "Linh", "ACC101", "2026-02-10"),
    ("S1000002", "Smith", "Jordan", "ENG205", "2026-02-11"),
    ("S1000003", "Patel", "Asha", "ACC101", "2026-02-12"),
]


@pytest.fixture
def load(spark):
    students = spark.createDataFrame(
        [(a, b, c) for a, b, c, _, _ in GOLDEN] + [("S1000009", "No", "Enrolment")],
        "student_id string, family_name string, given_name string",
    )
    enrolments = spark.createDataFrame(
        [(a, d, date.fromisoformat(e), "ACTIVE") for a, _, _, d, e in GOLDEN]
        + [("S1000001", "OLD999", date(2020, 1, 1), "WITHDRAWN")],
        "student_id string, course_code string, enrolled_date date, status string",
    ).withColumnRenamed("student_id", "e_student_id")

    def make(status="ACTIVE"):
        joined = staging_join(
            students, enrolments, ("student_id", "e_student_id"), F.col("status") == status,
            ["student_id", "family_name", "given_name", "course_code", "enrolled_date"],
        )
        return joined.toDF(*COLUMNS)

    return make


def job(spark, load, folder, **kw):
    return DownloadJob(**{
        "name": "student_download_v1", "load": load, "columns": COLUMNS, "order_by": ["STUDENT_ID"],
        "directory": f"{folder}/incoming", "pattern": "student_{yyyymmdd}.csv", "run_date": date(2026, 2, 13),
        "staging_folder": f"{folder}/staging", "dates_as": {"ENROLLED_DATE": "YYYY-MM-DD"},
        "header": ",".join(COLUMNS), "not_null": ["STUDENT_ID"],
        "golden": spark.createDataFrame(GOLDEN, COLUMNS), **kw,
    })


def test_worked_job(spark, load, folder):
    done = run_download(job(spark, load(), folder))
    assert done.passed and os.path.isdir(f"{folder}/staging/STG_STUDENT_DOWNLOAD_V1")
    assert [os.path.basename(f) for f in done.files] == ["student_20260213.csv"]
    assert Path(done.files[0]).read_text() == "\n".join(",".join(r) for r in [COLUMNS, *GOLDEN]) + "\n"
    again = run_download(job(spark, load(), folder))
    assert again.files == done.files and rows(again.delivered) == sorted(GOLDEN)


def test_empty_extract_is_delivered(spark, load, folder):
    done = run_download(job(spark, load("NOBODY"), folder, golden=None))
    assert done.passed and Path(done.files[0]).read_text() == ",".join(COLUMNS) + "\n"


def test_failing_check_is_an_error_after_delivery(spark, load, folder):
    wrong = load().withColumn("STUDENT_ID", F.nullif("STUDENT_ID", F.lit("S1000002")))
    with pytest.raises(VerificationError, match="no null values in STUDENT_ID") as caught:
        run_download(job(spark, wrong, folder))
    assert os.path.isfile(caught.value.delivery.files[0]) and caught.value.delivery.staging.count() == 3
    lenient = run_download(job(spark, wrong, folder), strict=False)
    results = {r.assertion: r.passed for r in lenient.checks.collect()}
    assert results == {
        "row count": True, "no null values in STUDENT_ID": False, "header matches the sample": True, "golden rows": False,
    }


def test_header_must_match_exactly(spark, load, folder):
    done = run_download(job(spark, load(), folder, header=",".join(COLUMNS) + " "), strict=False)
    assert not done.passed


def test_unique_key(spark, load):
    twice = load().unionByName(load())
    assert assertions.duplicate_keys(twice, ["STUDENT_ID"]).count() == 3
    assert assertions.assert_unique(twice, ["STUDENT_ID"]).first().passed is False
    assert assertions.assert_unique(load(), ["STUDENT_ID"]).first().passed is True


@pytest.mark.parametrize("fmt, ext", [("csv", "csv"), ("json", "json"), ("xml", "xml"), ("fixed", "dat")])
def test_upload_equals_what_was_delivered(spark, load, folder, fmt, ext):
    layout = [FixedColumn(c, 12) for c in COLUMNS]
    done = run_download(job(
        spark, load(), folder, fmt=fmt, pattern="s." + ext, layout=layout, header=None, golden=None,
    ))
    schema = ", ".join(f"{c} STRING" for c in COLUMNS)

    def upload(batch):
        return run_upload(spark, done.files, fmt, schema, "student_upload_v1", f"{folder}/in", batch, layout=layout)

    upload("1")
    upload("1")
    assert rows(upload("2").distinct()) == sorted(GOLDEN) and upload("2").count() == 6


def test_upload_checks_before_it_writes(spark, folder):
    Path(folder, "x.csv").write_text("STUDENT_ID\nS1\nbad\nbad\n")

    def rules():
        return [contract.matches("STUDENT_ID", F.col("STUDENT_ID"), "^S")]

    with pytest.raises(ContractError, match=r"'bad' does not match \^S \(2 rows\)"):
        run_upload(spark, f"{folder}/x.csv", "csv", "STUDENT_ID STRING", "up", folder, "1", rules)
    assert not os.path.exists(f"{folder}/STG_UP")


@pytest.mark.parametrize(
    "fmt, body, problem",
    [
        ("csv", "k,n\na,1\nb,x\n", r"does not parse \(1 rows\)"),
        ("json", '{"k": "a", "n": 1}\n{oops\n', "does not parse"),
        ("xml", "<rows><row><k>a</k><n>x</n></row></rows>", "does not parse"),
        ("fixed", "aaaa0001\nbbbb00x1\n", "does not parse"),
        ("fixed", "aaaa0001\nshort\n", "does not parse"),
    ],
)
def test_upload_of_broken_records(spark, folder, fmt, body, problem):
    Path(folder, "in").write_text(body)
    layout = [FixedColumn("k", 4), FixedColumn("n", 4, "int", "right", "0")]
    with pytest.raises(ContractError, match=problem):
        run_upload(spark, f"{folder}/in", fmt, "k STRING, n INT", "up", folder, "1", layout=layout)
    assert not os.path.exists(f"{folder}/STG_UP")


def test_upload_checks_the_header(spark, folder):
    Path(folder, "in").write_text("n,k\n1,a\n")
    with pytest.raises(Exception, match="(?i)header"):
        run_upload(spark, f"{folder}/in", "csv", "k STRING, n STRING", "up", folder, "1")


def test_golden_lengths_and_columns(spark):
    one = spark.createDataFrame([("a", 1)], "k string, v int")
    two = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    got = assertions.golden_compare(one, two, ["k", "v"], ["k"]).orderBy("position").collect()
    assert [(r.position, r.matches, r.differing) for r in got] == [(1, True, ""), (2, False, "k,v")]
    swapped = assertions.assert_golden(two.select("v", "k"), two, ["k", "v"], ["k"]).first()
    assert swapped.passed is False and "header" in swapped.detail
    beyond = two.unionByName(spark.createDataFrame([(f"x{i}", i) for i in range(9)], "k string, v int"))
    changed = beyond.withColumn("v", F.when(F.col("k") == "x8", -1).otherwise(F.col("v")))
    assert assertions.assert_golden(changed, beyond, ["k", "v"], ["k"]).first().passed is True


def test_golden_lines(spark):
    a = spark.createDataFrame([(i, f"l{i}") for i in range(8)], "line_no int, line string")
    b = a.withColumn("line", F.when(F.col("line_no") == 5, "x").otherwise(F.col("line")))
    got = assertions.golden_lines(a, b).orderBy("position").collect()
    assert [r.matches for r in got] == [True] * 5 + [False]


def test_verdict_and_confidence(spark):
    results = spark.createDataFrame([("a", "pass"), ("a", ""), ("b", "fail"), ("c", None)], "job string, result string")
    assert rows(assertions.verdict(results, ["job"])) == [("a", True), ("b", False), ("c", True)]
    jobs = spark.createDataFrame([("a",), ("b",), ("c",)], "job string")
    # A testing block without any assertion brings no row, so it does not count.
    asserted = spark.createDataFrame([("a", "x"), ("a", "y")], "job string, assertion string")
    files = spark.createDataFrame([("b", "golden.csv")], "job string, path string")
    assert rows(assertions.confidence_flag(jobs, asserted, files)) == [("a", True), ("b", True), ("c", False)]


def test_error_summary(spark):
    df = spark.createDataFrame([("a", "error"), ("a", "warning"), ("b", "warning")], "job string, severity string")
    assert rows(assertions.error_summary(df, ["job"])) == [("a", 1, 1, False), ("b", 0, 1, True)]


def test_report(spark, folder):
    jobs = spark.createDataFrame([("j", True, False), ("k", False, True)], "job string, passed boolean, confident boolean")
    items = spark.createDataFrame([("j", 0, "ords", "p.sql", "T")], "job string, seq int, item string, path string, generated_at string")
    warnings = spark.createDataFrame([("j", 0, "junk")], "job string, seq int, message string")
    output = spark.createDataFrame([("j", " 1 passed \n"), ("k", "x" * 7000)], "job string, text string")
    report.write_report(report.report_lines(jobs, items, warnings, output), f"{folder}/r")
    lines = [r.value for r in spark.read.text(f"{folder}/r/job=j").collect()]
    assert lines == [
        "# Run report — j", "", report.LOW_CONFIDENCE, "", report.PASS_LINE, "", "## Artifacts",
        "- ords: `p.sql` (generated T)", "", "## Validation warnings", "- ⚠ junk", "", "## Test output", "```",
        "1 passed", "```",
    ]
    other = [r.value for r in spark.read.text(f"{folder}/r/job=k").collect()]
    assert report.LOW_CONFIDENCE not in other and report.FAIL_LINE in other and "x" * 6000 in other


def test_sections_of_a_plan_reach_the_scan(spark, folder):
    spark.range(10).select(F.col("id").alias("k"), F.lit("O").alias("s"), F.lit(1).alias("unused")).write.parquet(f"{folder}/d")
    spark.range(10).select(F.col("id").alias("m")).write.parquet(f"{folder}/m")
    joined = staging_join(
        spark.read.parquet(f"{folder}/m"), spark.read.parquet(f"{folder}/d"), ("m", "k"), F.col("s") == "O", ["m"]
    )
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(s,O)" in plan and "unused" not in plan
