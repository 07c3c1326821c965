"""Text and date functions on the literal cases."""

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablehandoff.functions import dates, state, text


def value(spark, column, **cells):
    df = spark.createDataFrame([tuple(cells.values())], ", ".join(f"{n} string" for n in cells))
    return df.select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "body",
    ["a\nb\nc", "", "\n", "a\n\n", "a\r\nb\rc", "a\x0bb\x0cc\x1cd\x85e f", "\r\n", "a\r\n "],
)
def test_lines_are_those_of_splitlines(spark, body):
    assert value(spark, text.lines(F.col("t")), t=body) == body.splitlines()


def test_sample_head(spark):
    long = "\n".join(f"row{i}" for i in range(50))
    df = spark.createDataFrame([(long,), ("a\nb\nc",), ("",)], "t string")
    long_row, short_row, empty = text.sample_head(df, "t").collect()
    assert long_row["head"].split("\n")[:20] == [f"row{i}" for i in range(20)]
    assert long_row["head"].endswith("\n[truncated: showing first 20 of 50 rows]")
    assert (long_row.total, long_row.truncated) == (50, True)
    assert (short_row["head"], short_row.total, short_row.truncated) == ("a\nb\nc", 3, False)
    assert (empty["head"], empty.total) == ("", 0)


@pytest.mark.parametrize("body", ["  a b \n", "　x\xa0\x1f", "\t\x85", "plain", "   a​ "])
def test_strip_like_python(spark, body):
    assert value(spark, text.strip(F.col("t")), t=body) == body.strip()


NAMES = st.text("aZ09_- é.", max_size=6) | st.integers(0, 60).map(lambda n: "k" + "9" * n)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(NAMES, min_size=1, max_size=30))
def test_names_match_their_definition(spark, raw):
    c = text.normalize_name(F.col("t"))
    df = spark.createDataFrame([(r,) for r in raw], "t string")
    for row in df.select("t", c.alias("name"), text.valid_name(c).alias("valid")).collect():
        assert row.name == row.t.strip().lower().replace("-", "_")
        letters = set("abcdefghijklmnopqrstuvwxyz")
        allowed = letters | set("0123456789_")
        want = 3 <= len(row.name) <= 41 and row.name[0] in letters and set(row.name) <= allowed
        assert row.valid is want, row.name


def test_derived_names(spark):
    job = F.col("t")
    got = value(
        spark,
        F.array(
            text.staging_table(job), text.dashed_name(job, "x-"), text.branch_name(job, "x/"),
            text.endpoint_path(job, "/api/"), text.output_path(job, "out/{job}_module.sql"),
        ),
        t="my_job_v1",
    )
    assert got == ["STG_MY_JOB_V1", "x-my-job-v1", "x/my_job_v1", "/api/my_job_v1/", "out/my_job_v1_module.sql"]


def test_fences(spark):
    c = text.strip_fences(F.col("t"))
    assert value(spark, c, t="```sql\nSELECT 1;\n```") == "SELECT 1;"
    assert value(spark, c, t="\n ```\na\nb\n``` \n") == "a\nb"
    assert value(spark, c, t="  plain \n") == "  plain \n"
    assert value(spark, c, t="```no newline```") == "```no newline```"


def test_front_matter(spark):
    whole = "---\njob_name: x\nmode: deploy\n---\n\n## Notes\n---\nmore\n"
    c = F.col("t")
    assert value(spark, text.front_matter_header(c), t=whole) == "job_name: x\nmode: deploy"
    assert value(spark, text.front_matter_body(c), t=whole) == "## Notes\n---\nmore"
    for bad in ("no block", " ---\na: 1\n---\n", "---\nnever closed"):
        assert value(spark, text.has_front_matter(c), t=bad) is False
        assert value(spark, text.front_matter_header(c), t=bad) is None


def test_redact(spark):
    c = F.col("t")
    assert value(spark, text.redact(c, F.col("v")), t="a tok b tok", v="tok") == "a *** b ***"
    assert value(spark, text.redact(c, F.col("v")), t="abc", v="") == "abc"
    many = text.redact_all(c, F.array(F.lit("se"), F.lit("secret"), F.lit("")))
    assert value(spark, many, t="my secret sense") == "my *** ***n***"


def test_caps_are_strict(spark):
    for n, over in ((8_000, False), (8_001, True)):
        assert value(spark, text.over_cap(F.col("t")), t="x" * n) is over
    assert value(spark, text.over_cap(F.col("t"), text.TOTAL_CHAR_CAP), t="x" * 48_001) is True


@pytest.mark.parametrize(
    "path, suffix, kind",
    [
        ("a/b.SQL", ".sql", "verbatim"), ("x.tar.csv", ".csv", "sample"), ("a.exe", ".exe", None),
        ("noext", "", None), ("dir.d/noext", "", None), (".bashrc", "", None), ("a/.hidden", "", None),
        ("m.xlsx", ".xlsx", "sheet"), ("d.docx", ".docx", "document"), ("p.PDF", ".pdf", "document"),
        ("s.dat", ".dat", "sample"), ("s.txt", ".txt", "sample"),
    ],
)
def test_file_kind(spark, path, suffix, kind):
    assert value(spark, text.suffix(F.col("t")), t=path) == suffix
    assert value(spark, text.file_kind(F.col("t")), t=path) == kind


def test_hash_and_ids(spark):
    import hashlib

    digest = value(spark, text.content_hash(F.col("t")), t="abc")
    assert digest == "sha256:" + hashlib.sha256(b"abc").hexdigest() and len(digest) == 71
    assert value(spark, text.short_id(F.col("t")), t="0123456789") == "01234567"
    assert value(spark, text.short_id(F.col("t")), t="") == "unknown"
    assert value(spark, text.short_id(F.col("t")), t=None) == "unknown"
    assert value(spark, text.run_label(F.col("t")), t=None) == "local"


def test_tail(spark):
    body = "a" * 10 + "b" * 6000 + "\n\n"
    assert value(spark, text.tail_chars(F.col("t")), t=body) == "b" * 6000
    assert value(spark, text.tail_chars(F.col("t")), t=" short ") == "short"


def test_markdown_row(spark):
    row = value(spark, text.markdown_row([F.col("a"), F.col("b")]), a="STUDENT_ID", b="StudentId")
    assert row == "| STUDENT_ID | StudentId |"
    assert value(spark, text.markdown_row([F.col("a"), F.col("b")]), a=None, b="x|y") == "|  | x|y |"


def test_dates(spark):
    df = spark.sql("select timestamp'2026-02-10 13:04:05' as t, date'2026-02-10' as d")
    row = df.select(
        dates.format_date(F.col("d")).alias("a"),
        dates.format_date(F.col("t"), "DD/MM/YY HH24:MI:SS").alias("b"),
        dates.utc_stamp(F.col("t")).alias("c"),
    ).first()
    assert tuple(row) == ("2026-02-10", "10/02/26 13:04:05", "2026-02-10T13:04:05Z")
    with pytest.raises(ValueError, match="MON"):
        dates.spark_pattern("DD-MON-YYYY")
    assert dates.resolve_file_name("s_{yyyymmdd}.csv", date(2026, 2, 10)) == "s_20260210.csv"
    assert datetime.now()  # the run date is the caller's, nothing reads the clock


def test_state_defaults_and_extras(spark):
    c = state.read_state(F.col("t"))
    old = value(spark, c, t='{"job_name": "j", "extra_field": {"a": 1}}')
    assert (old.schema_version, old.job_name, old.last_mode) == (1, "j", "")
    assert old.artifacts == {} and old.stage_history == {}
    assert old.extras == {"extra_field": '{"a":1}'}


def test_state_round_trip(spark):
    source = (
        '{"schema_version":2,"job_name":"j","input_hashes":{"job/a.sql":"sha256:x"},'
        '"artifacts":{"ords":{"path":"p","input_hash_at_gen":"h","generated_at":"t"}},'
        '"stage_history":{"sql":[{"generated_at":"t1","input_hash":"h1"},{"generated_at":"t0"}]}}'
    )
    first = value(spark, state.read_state(F.col("t")), t=source)
    written = value(spark, state.write_state(state.read_state(F.col("t"))), t=source)
    again = value(spark, state.read_state(F.col("t")), t=written)
    assert again.asDict(True) | {"extras": {}} == first.asDict(True) | {"extras": {}}
    assert [s.generated_at for s in again.stage_history["sql"]] == ["t1", "t0"]


def test_flatten_refs(spark):
    c = state.flatten_refs(
        F.array(F.lit("a"), F.lit("b")), F.lit(None).cast("array<string>"), F.array(F.lit("c"))
    )
    assert value(spark, c, t="") == ["a", "b", "c"]
