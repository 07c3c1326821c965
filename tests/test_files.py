"""Sources and sinks: round trips, names, numbered files, listings."""

import os
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablehandoff.operators import assertions
from tablehandoff.sinks import versions
from tablehandoff.sinks import files as sinks
from tablehandoff import storage
from tablehandoff.sinks import tables
from tablehandoff.sources import files, relational
from tablehandoff.sources.files import FixedColumn

DAY = date(2026, 2, 10)
SCHEMA = "STUDENT_ID STRING, FAMILY_NAME STRING, COURSE_CODE STRING, N BIGINT"
DATA = [
    ("S1000003", "Patel", "ACC101", 3),
    ("S1000001", 'Ng, "Linh"', "ACC101", 1),
    ("S1000002", None, "ENG205", None),
    ("S1000001", "Åsa", "ENG205", 2),
]
ORDER = ["STUDENT_ID", "COURSE_CODE"]
LAYOUT = [
    FixedColumn("STUDENT_ID", 8), FixedColumn("FAMILY_NAME", 12), FixedColumn("COURSE_CODE", 6),
    FixedColumn("N", 5, "bigint", "right", "0"),
]


@pytest.fixture
def extract(spark):
    return spark.createDataFrame(DATA, SCHEMA).repartition(3)


def deliver(fmt, df, folder, **kw):
    if fmt == "csv":
        return sinks.deliver_csv(df, folder, "s_{yyyymmdd}.csv", DAY, ORDER, **kw)
    if fmt == "json":
        return sinks.deliver_json(df, folder, "s_{yyyymmdd}.json", DAY, ORDER, **kw)
    if fmt == "fixed":
        return sinks.deliver_fixed(df, LAYOUT, folder, "s_{yyyymmdd}.dat", DAY, ORDER, **kw)
    return sinks.deliver_xml(df, folder, "s_{yyyymmdd}.xml", DAY, ORDER, row_tag="row", root_tag="rows", **kw)


def read(spark, fmt, paths):
    if fmt == "csv":
        return files.read_delimited(spark, paths, SCHEMA)
    if fmt == "json":
        return files.read_json_file(spark, paths, SCHEMA)
    if fmt == "fixed":
        return files.read_fixed(spark, paths, LAYOUT)
    return files.read_xml_file(spark, paths, SCHEMA, "row")


@pytest.mark.parametrize("fmt", ["csv", "json", "fixed", "xml"])
@pytest.mark.parametrize("per_file", [None, 100, 1])
def test_round_trip(spark, extract, folder, fmt, per_file):
    paths = deliver(fmt, extract, folder, rows_per_file=per_file)
    assert rows(read(spark, fmt, paths)) == rows(extract)
    names = sorted(os.path.basename(p) for p in paths)
    # The argument decides the names, whatever the number of files.
    assert names[0].startswith("s_20260210-00000." if per_file else "s_20260210.")
    assert (len(names) > 1) == (per_file == 1)
    left = [n for n in os.listdir(folder) if not n.endswith(".crc")]
    assert sorted(left) == names


def test_csv_header_and_order(extract, folder):
    (path,) = deliver("csv", extract, folder)
    lines = Path(path).read_text().splitlines()
    assert lines[0] == "STUDENT_ID,FAMILY_NAME,COURSE_CODE,N"
    assert [line.split(",")[0] for line in lines[1:]] == ["S1000001", "S1000001", "S1000002", "S1000003"]
    assert lines[1] == 'S1000001,"Ng, ""Linh""",ACC101,1'


def test_empty_extract_still_has_the_header(spark, extract, folder):
    (path,) = deliver("csv", extract.where("N > 99"), folder)
    assert Path(path).read_text() == "STUDENT_ID,FAMILY_NAME,COURSE_CODE,N\n"
    assert read(spark, "csv", [path]).count() == 0


def test_numbered_files_follow_the_order(spark, folder):
    # One key holds a third of the rows, and one row exists many times.
    data = [("K1" if i % 3 else "K0", f"{i % 4:03d}") for i in range(300)] + [("K5", "same")] * 150
    df = spark.createDataFrame(data, "k string, v string").repartition(4)
    paths = sinks.deliver_csv(df, folder, "big.csv", DAY, ["k", "v"], rows_per_file=60)
    assert len(paths) > 3
    seen = []
    for p in paths:
        head, *body = Path(p).read_text().splitlines()
        assert head == "k,v" and len(body) < 200
        seen += [tuple(line.split(",")) for line in body]
    assert seen == sorted(data)


@pytest.mark.parametrize("fmt", ["csv", "json", "fixed", "xml"])
def test_a_task_writes_several_files(spark, folder, fmt, monkeypatch):
    # One row makes up a third; 61 files of 5 rows, the last of 2, by 8 tasks at most.
    data = [(f"S{i * 37 % 200:07d}", "x", "c", i % 3) for i in range(202)] + [("S0000007", "y", "c", 1)] * 100
    df = spark.createDataFrame(data, "STUDENT_ID string, FAMILY_NAME string, COURSE_CODE string, N int").repartition(3)
    written = []
    real = sinks.publish

    def publish(df, staged, *rest):
        written.extend(n for n in os.listdir(staged) if n.startswith("part-"))
        return real(df, staged, *rest)

    monkeypatch.setattr(sinks, "publish", publish)
    monkeypatch.setattr(sinks, "TASK_FILES", 10)
    paths = deliver(fmt, df, folder, rows_per_file=5)
    assert len(paths) == 61 and [sinks.part_order(n)[1] for n in written].count(0) <= 8
    each = [read(spark, fmt, [p]).select("STUDENT_ID", "FAMILY_NAME", "COURSE_CODE", "N") for p in (paths[0], paths[30], paths[-1])]
    want = sorted(data)
    assert [rows(df) for df in each] == [want[:5], want[150:155], want[300:]]
    assert rows(read(spark, fmt, paths)) == want


def test_part_files_are_ordered_by_number():
    names = ["part-00002-a-b-c000.csv", "part-100000-a-c000.csv", "part-00002-a-b-c1000", "part-00002-a-b-c999.json"]
    assert sorted(names, key=sinks.part_order) == [names[0], names[3], names[2], names[1]]


def test_smaller_redelivery_removes_old_parts(extract, folder):
    deliver("csv", extract, folder, rows_per_file=1)
    Path(folder, "other.csv").write_text("x")
    (path,) = deliver("csv", extract, folder)
    names = sorted(n for n in os.listdir(folder) if not n.startswith("."))
    assert names == ["other.csv", os.path.basename(path)]


def test_fixed_line_and_overflow(extract, folder):
    (path,) = deliver("fixed", extract, folder)
    lines = Path(path).read_text().splitlines()
    assert lines[0] == 'S1000001Ng, "Linh"  ACC10100001' and {len(line) for line in lines} == {31}
    long = extract.withColumn("FAMILY_NAME", F.lit("x" * 13))
    with pytest.raises(sinks.LayoutError, match="FAMILY_NAME: 4 rows"):
        deliver("fixed", long, folder)
    broken = extract.withColumn("FAMILY_NAME", F.lit("a\nb"))
    with pytest.raises(sinks.LayoutError):
        deliver("fixed", broken, folder)


def test_csv_rejects_line_breaks(extract, folder):
    broken = extract.withColumn("FAMILY_NAME", F.when(F.col("N") == 1, "a\nb").otherwise("c"))
    with pytest.raises(sinks.LayoutError, match="FAMILY_NAME"):
        deliver("csv", broken, folder)
    assert not [n for n in os.listdir(folder) if n.endswith(".csv")]


def test_default_checks(spark, extract, folder):
    header = "STUDENT_ID,FAMILY_NAME,COURSE_CODE,N"
    (path,) = deliver("csv", extract, folder)
    name = os.path.basename(path)
    good = assertions.default_checks(spark, folder, [name], "csv", SCHEMA, header)
    assert [r.passed for r in good.collect()] == [True] * 4
    absent = assertions.default_checks(spark, folder, ["none.csv"], "csv", SCHEMA, header).collect()
    assert [r.passed for r in absent] == [False, True, False, False]
    Path(folder, "bad.csv").write_text(header + " \nS1,a,b,notanumber\n")
    bad = assertions.default_checks(spark, folder, ["bad.csv"], "csv", SCHEMA, header)
    assert {r.assertion: r.passed for r in bad.collect()} == {
        "file exists": True, "file is not empty": True,
        "header matches the sample": False, "parses as csv": False,
    }
    Path(folder, "e.csv").write_text("")
    empty = assertions.default_checks(spark, folder, ["e.csv"], "csv", SCHEMA, header)
    assert [r.passed for r in empty.collect()][:3] == [True, False, False]
    for fmt, broken in (("json", "{oops\n"), ("fixed", "short\n"), ("xml", "<rows><row><N>x</N></row></rows>")):
        Path(folder, f"b.{fmt}").write_text(broken)
        out = assertions.default_checks(spark, folder, [f"b.{fmt}"], fmt, SCHEMA, row_tag="row", layout=LAYOUT)
        assert out.collect()[-1].passed is False


@pytest.fixture
def tree(tmp_path):
    for name, body in {
        "sql/load.sql": "select 1;\n", "sql/deep/x.sql": "x", "specs/.gitkeep": "", "top.txt": " \n",
        "docs/a b+c.txt": "\n hello\n\nworld \n", "docs/é.txt": "ü", "sql/empty.sql": "",
    }.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body)
    return tmp_path


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_corpus(spark, tree, scheme):
    got = files.read_corpus(spark, f"{scheme}{tree}")
    assert rows(got) == [
        ("docs/a b+c.txt", "hello\n\nworld"), ("docs/é.txt", "ü"), ("sql/deep/x.sql", "x"), ("sql/load.sql", "select 1;"),
    ]


def test_inventory(spark, tree):
    got = files.list_inventory(spark, str(tree), ["sql", "specs"])
    assert rows(got.select("top", "rel_path", "size")) == [
        ("sql", "sql/deep/x.sql", 1), ("sql", "sql/empty.sql", 0), ("sql", "sql/load.sql", 10),
    ]
    assert files.list_inventory(spark, str(tree)).count() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_landing_lookup(spark, tmp_path):
    for name in ("student_2.csv", "student_1.csv", "other.csv"):
        (tmp_path / name).write_text("x")
    assert files.landing_lookup(spark, f"{tmp_path}/", "student_") == f"{tmp_path}/student_1.csv"
    assert files.landing_lookup(spark, str(tmp_path), "none") is None


def test_file_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\nthree\n")
    lines = files.file_lines(spark, str(tmp_path / "a.txt")).orderBy("line_no")
    assert [r.line for r in lines.collect()] == ["one", "two", "three"]


def test_sample_lines(spark, tmp_path):
    from tablehandoff.operators.rows import sample_lines

    (tmp_path / "long.csv").write_text("".join(f"row{i}\n" for i in range(50)))
    (tmp_path / "short.csv").write_text("a\nb\n")
    head, totals = sample_lines(files.file_lines(spark, str(tmp_path)))
    long = head.where("file = 'long.csv'").orderBy("line_no").collect()
    assert [r.line for r in long] == [f"row{i}" for i in range(20)]
    assert rows(totals) == [("long.csv", 50, True), ("short.csv", 2, False)]


def test_jdbc_url():
    base = {"host": "h", "port": "1533"}
    assert relational.jdbc_url({**base, "sid": "S"}) == "jdbc:oracle:thin:@h:1533:S"
    assert relational.jdbc_url({**base, "service": "svc"}) == "jdbc:oracle:thin:@//h:1533/svc"
    with pytest.raises(KeyError, match="service"):
        relational.jdbc_url(base)


def test_jdbc_options():
    meta = {"host": "h", "port": 1521, "service": "s", "user": "u", "password": "p"}
    plain = relational.read_options(meta, "students")
    assert plain["dbtable"] == "students" and "partitionColumn" not in plain
    query = relational.read_options(meta, "select a from b", "id", (1, 100), 8)
    assert query["dbtable"] == "(select a from b) q"
    assert (query["partitionColumn"], query["lowerBound"], query["upperBound"], query["numPartitions"]) == (
        "id", "1", "100", "8",
    )
    with pytest.raises(ValueError):
        relational.read_options(meta, "students", partitions=4)


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_ranges_by_histogram_share_out_all_rows(spark, partitions):
    # Half of the rows have one key, most others lie close together, some are null.
    keys = [7] * 500 + [i % 60 for i in range(400)] + [10_000 + 900 * i for i in range(95)] + [None] * 5
    df = spark.createDataFrame(list(enumerate(keys)), "id int, k int")
    df.createOrReplaceTempView("keyed")
    counts = spark.sql(relational.histogram_query("keyed", "k", 0, 100_000, 100_000)).collect()
    assert sum(r.n for r in counts) == 995 and counts[0].low == 0
    cells = [relational.Cell(*r) for r in counts]
    found = relational.range_predicates("k", cells, partitions, "id")
    parts = [[r.id for r in df.where(p).collect()] for p in found]
    assert sorted(i for p in parts for i in p) == list(range(1000))
    assert len(found) <= 3 * partitions + 2 and max(map(len, parts)) <= 2 * -(-995 // partitions)
    whole = relational.range_predicates("k", cells, partitions)
    assert sorted(r.id for p in whole for r in df.where(p).collect()) == list(range(1000))


def test_histogram_of_nothing_and_literals():
    assert relational.range_predicates("k", [], 4) == ["k is null"]
    one = relational.range_predicates("k", [relational.Cell("a'b", "a'b", 3), relational.Cell("c", "d", 9)], 2)
    assert one == ["k < 'c'", "k >= 'c'", "k is null"]
    assert relational.sql_value(date(2024, 1, 2)) == "date '2024-01-02'"
    with pytest.raises(TypeError):
        relational.sql_value(None)


def test_refresh_staging_may_read_itself(spark, folder, extract):
    first = tables.refresh_staging(extract, "job_v1", folder)
    assert rows(first) == rows(extract) and os.path.isdir(f"{folder}/STG_JOB_V1")
    again = tables.refresh_staging(first.where("N = 1"), "job_v1", folder)
    assert again.count() == 1
    with pytest.raises(Exception):
        tables.refresh_staging(again.select(F.raise_error(F.lit("boom"))), "job_v1", folder)
    assert tables.read_staging(spark, "job_v1", folder).count() == 1


def test_history_append_is_repeatable(spark, folder, extract):
    path = f"{folder}/h"
    tables.append_history(extract, path, "1")
    tables.append_history(extract.limit(1), path, "2")
    tables.append_history(extract, path, "1")
    assert spark.read.parquet(path).count() == 5


def test_repeated_batch_keeps_nothing_of_the_attempt_before(spark, folder):
    path, batch = f"{folder}/h", "2024-01-01 10:00/a=b%"
    rows_of = spark.createDataFrame([("j1", 1), ("j2", 2)], "job string, v int")
    tables.append_history(rows_of, path, batch, ["job"])
    tables.append_history(rows_of, path, "other", ["job"])
    tables.append_history(rows_of.where("v = 1"), path, batch, ["job"])
    got = spark.read.parquet(path).where(F.col("batch") == batch).select("job", "v")
    assert rows(got) == [("j1", 1)]
    assert spark.read.parquet(path).count() == 3


def test_redeliver_without_rows(spark, folder):
    path = f"{folder}/t"
    tables.redeliver(spark.createDataFrame([("a:1", 1), ("b", 2), ("c", 3)], "job_name string, v int"), path)
    tables.redeliver(spark.createDataFrame([("b", 9)], "job_name string, v int"), path, jobs=["a:1", "b"])
    assert rows(spark.read.parquet(path).select("job_name", "v")) == [("b", 9), ("c", 3)]


def test_redeliver_replaces_only_its_job(spark, folder):
    path = f"{folder}/t"
    tables.redeliver(spark.createDataFrame([("a", 1), ("b", 2)], "job_name string, v int"), path)
    for _ in range(2):
        tables.redeliver(spark.createDataFrame([("a", 9)], "job_name string, v int"), path)
    assert rows(spark.read.parquet(path).select("job_name", "v")) == [("a", 9), ("b", 2)]


def test_write_upsert(spark, folder):
    path = f"{folder}/state"
    schema = "job string, step string, at int, status string"
    tables.write_upsert(path, spark.createDataFrame([("a", "s", 1, "x"), ("b", "s", 1, "y")], schema), ["job", "step"], ["at"], "job")
    tables.write_upsert(path, spark.createDataFrame([("a", "s", 2, "z"), ("a", "t", 2, "n")], schema), ["job", "step"], ["at"], "job")
    tables.write_upsert(path, spark.createDataFrame([("a", "s", 1, "late")], schema), ["job", "step"], ["at"], "job")
    got = spark.read.parquet(path).select("job", "step", "at", "status")
    assert rows(got) == [("a", "s", 2, "z"), ("a", "t", 2, "n"), ("b", "s", 1, "y")]


def test_materialize_only_when_changed(spark, folder, extract):
    from tablehandoff.operators.snapshots import table_fingerprint

    fp = table_fingerprint(extract)
    assert fp == table_fingerprint(extract.repartition(1))
    assert fp != table_fingerprint(extract.unionByName(extract.limit(1)))
    path = f"{folder}/out"
    assert tables.materialize_if_changed(extract, fp, path) is True
    assert tables.materialize_if_changed(extract.limit(0), fp, path) is False
    assert rows(versions.read_current(spark, path)) == rows(extract)
    assert tables.materialize_if_changed(extract.limit(1), "other", path) is True
    assert versions.read_current(spark, path).count() == 1
    storage.delete(spark, path)
    assert tables.materialize_if_changed(extract, "other", path) is True


def test_zero_padded_numbers(spark, folder):
    from tablehandoff.sinks.files import deliver_fixed
    from tablehandoff.sources.files import FixedColumn, read_fixed

    layout = [FixedColumn("id", 4), FixedColumn("n", 6, "int", "right", "0")]
    df = spark.createDataFrame([("a", 0), ("b", 120), ("c", None)], "id string, n int")
    files = deliver_fixed(df, layout, folder + "/z", "z.dat", date(2024, 1, 1), ["id"])
    assert [tuple(r) for r in read_fixed(spark, files, layout).orderBy("id").collect()] == [("a", 0), ("b", 120), ("c", None)]


def test_upsert_null_and_text_partitions(spark, folder):
    from tablehandoff.sinks.tables import write_upsert

    kind = "g string, k int, v string, s int"
    path = folder + "/t"
    write_upsert(path, spark.createDataFrame([(None, 1, "x", 1), ("01", 1, "x", 1), ("1", 1, "x", 1)], kind), ["g", "k"], ["s"], "g")
    write_upsert(path, spark.createDataFrame([(None, 2, "y", 2), ("01", 1, "y", 2)], kind), ["g", "k"], ["s"], "g")
    got = spark.read.schema(kind).parquet(path).select("g", "k", "v").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 1, "x"), (None, 2, "y"), ("01", 1, "y"), ("1", 1, "x")], key=str)


def test_an_update_of_one_key_leaves_other_files(spark, folder):
    kind, path = "g string, k int, v string, s int", f"{folder}/t"
    rows_of = [(g, k, "old", 1) for g in ("01", "1", None, "a b") for k in range(200)]

    def held():
        return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}

    tables.write_upsert(path, spark.createDataFrame(rows_of, kind), ["g", "k"], ["s"], "g", parts=8)
    before = held()
    updates = [("01", 7, "new", 2), (None, 3, "new", 2), ("a b", 5, "late", 0), ("z", 1, "first", 1)]
    tables.write_upsert(path, spark.createDataFrame(updates, kind), ["g", "k"], ["s"], "g", parts=8)
    after = held()
    gone = {p.rsplit("/", 1)[0] for p in before if p not in after}
    assert len(gone) == 3 and len({p.rsplit("/", 1)[0] for p in before}) == 32
    want = {(g, k): v for g, k, v, _ in rows_of} | {("01", 7): "new", (None, 3): "new", ("z", 1): "first"}
    got = tables.read_upsert(spark, path, spark.createDataFrame([], kind).schema).collect()
    assert {(r.g, r.k): r.v for r in got} == want and len(got) == len(want)


def test_upsert_prunes_folders_before_reading(spark, folder):
    kind, path = "g int, k int, s int", f"{folder}/t"
    tables.write_upsert(path, spark.createDataFrame([(i % 5, i, 1) for i in range(100)], kind), ["g", "k"], ["s"], "g")
    schema = spark.createDataFrame([], kind).schema
    some = tables._touched(spark.read.schema(schema).parquet(path), spark.createDataFrame([(3,)], "g int"), ["g"])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert some.count() == 20 and "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
