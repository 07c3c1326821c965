"""Reports of warnings and runs, kinds of files, lookups by prefix."""

import random

from pyspark.sql import functions as F

from conftest import rows
from tablehandoff.functions import text
from tablehandoff.sinks import report
from tablehandoff.sources import files


def test_warning_report(spark):
    warnings = spark.createDataFrame([("b", 2, "late"), ("a", 1, "one"), ("b", 1, "early")], "job string, seq int, message string")
    lines = [(r.job, r.line) for r in report.warning_report(warnings).orderBy("job", "section", "seq").collect()]
    head = ["# Validation warnings", ""]
    assert [x for j, x in lines if j == "a"] == [*head, "- ⚠ one"]
    assert [x for j, x in lines if j == "b"] == [*head, "- ⚠ early", "- ⚠ late"]
    assert report.warning_report(warnings.limit(0)).count() == 0


def test_run_link_comes_last(spark):
    jobs = spark.createDataFrame([("a", True, True), ("b", True, True)], "job string, passed boolean, confident boolean")
    items = spark.createDataFrame([], "job string, seq int, item string, path string, generated_at string")
    warnings = spark.createDataFrame([], "job string, seq int, message string")
    output = spark.createDataFrame([("a", "done")], "job string, text string")
    runs = spark.createDataFrame([("a", "https://ci/1"), ("b", ""), ("c", None)], "job string, url string")
    whole = report.report_lines(jobs, items, warnings, output, runs)
    lines = [r.line for r in whole.where("job = 'a'").orderBy("section", "seq").collect()]
    assert lines[-3:] == ["```", "", "[Workflow run](https://ci/1)"]
    without = report.report_lines(jobs, items, warnings, output)
    assert rows(whole.where("job = 'b'")) == rows(without.where("job = 'b'")) and whole.where("job = 'c'").count() == 0


def test_file_kind_problem(spark):
    df = spark.createDataFrame([("a/b.CSV",), ("sql/q.sql",), ("x/readme.md",), ("x/none",), (None,)], "path string")
    got = {r.path: r.p for r in df.select("path", text.file_kind_problem(F.col("path")).alias("p")).collect()}
    assert got["a/b.CSV"] is None and got["sql/q.sql"] is None
    assert got["x/readme.md"] == "readme.md: files of type '.md' cannot be read, only .csv, .dat, .docx, .pdf, .sql, .txt, .xlsx"
    assert got["x/none"].startswith("none: files of type '' cannot be read")


def test_first_matches(spark):
    draw = random.Random(5)
    names = ["".join(draw.choice("abé_") for _ in range(draw.randint(1, 6))) for _ in range(300)]
    prefixes = ["", "a", "ab", "é_a", "zz", "x" * 300, None, "a"] + names[:5]
    got = files.first_matches(
        spark.createDataFrame([(n,) for n in names] + [(None,)], "name string"),
        spark.createDataFrame([(p,) for p in prefixes], "prefix string"),
    )
    first = {p: min((n for n in names if n.startswith(p)), default=None, key=lambda n: n.encode()) for p in prefixes if p is not None}
    assert {r.prefix: r.name for r in got.collect()} == first
    assert "NestedLoop" not in got._jdf.queryExecution().toString()
    assert files.first_matches(spark.createDataFrame([("a",)], "name string"), spark.createDataFrame([], "prefix string")).count() == 0
