"""Contract rules, references, registries and the manifest report."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablehandoff.operators import contract, references
from tablehandoff.operators import rows as table
from tablehandoff.plans import manifests
from tablehandoff.registry import QUERIES
from test_snapshots import BASE, changed

KNOWN = ["git_main", "mule_dev", "mule_repo_dev", "oracle_dev", "sftp_dev"]
FILES = ["sql/load_staging.sql", "sql/export_query.sql", "samples/expected_output.csv"]
SET = ["ORACLE_DEV_USER", "ORACLE_DEV_PASSWORD", "MULE_REPO_TOKEN", "SFTP_DEV_USER"]



def case(manifest=BASE, files=FILES, text=None):
    header = json.dumps(manifest) if isinstance(manifest, dict) else manifest
    return header, f"---\n{header}\n---\nnotes" if text is None else text or None, files


CASES = {
    "fine": case(),
    "missing": case(None, [], ""),
    "no block": case(None, text="just text"),
    "name": case(changed(job_name="Student-Download!")),
    "mode": case(changed(mode="yolo")),
    "direction": case(changed(direction="sideways")),
    "format": case(changed(destination={"file_format": "parquet"})),
    "role": case(changed(sources={"sql": [{"file": "a", "role": "mystery_role"}]})),
    "misplaced role": case(changed(sources={"specs": [{"file": "a", "role": "export"}]})),
    "unknown field": case(changed(surprise=1)),
    "unknown inner field": case(changed(destination={"folder": "x"})),
    "three": case(changed(job_name="X", mode="yolo", surprise=1)),
    "absent": case(files=FILES[:1] + FILES[2:]),
    "orphan": case(files=[*FILES, "sql/orphan.sql", "tests/golden.csv"]),
    "connection": case(changed(destination={"connection": "sftp_prod"})),
}


def run_report(spark, cases, set_names, registry_error=None):
    """{job: (errors, warnings)}"""
    jobs = [(j, text, header) for j, (header, text, _) in cases.items()]
    there = [(j, f) for j, (_, _, files) in cases.items() for f in files]
    connections = spark.createDataFrame(
        [("oracle_dev", {"user": "ORACLE_DEV_USER", "password": "ORACLE_DEV_PASSWORD"}),
         ("mule_repo_dev", {"token": "MULE_REPO_TOKEN"}), ("sftp_dev", {"user": "SFTP_DEV_USER"}),
         ("git_main", {"token": "NEVER_USED"}), ("mule_dev", {})],
        "name string, secrets map<string,string>",
    )
    out = manifests.manifest_report(
        spark.createDataFrame(jobs, "job string, text string, header string"),
        spark.createDataFrame(there, "job string, path string"), connections,
        spark.createDataFrame([(n,) for n in set_names], "name string"), registry_error,
    ).collect()
    return {
        j: tuple([r.message for r in out if (r.job, r.severity) == (j, s)] for s in ("error", "warning"))
        for j in cases
    }


@pytest.fixture(scope="module")
def report(spark):
    return run_report(spark, CASES, SET)


SHAPES = {
    "unknown in item": (changed(sources={"sql": [{"file": "a", "role": "export", "x": 1}]}), ["sources.sql: unknown field 'x'"]),
    "list as text": (changed(sources={"sql": "a.sql"}), ["sources.sql: must be a list"]),
    "item as text": (changed(sources={"specs": ["a.txt"]}), ["sources.specs: every item must be a mapping"]),
    "no file": (changed(sources={"specs": [{"role": "business_rules"}]}), ["sources.specs: field file required"]),
    "file no text": (changed(sources={"specs": [{"file": 5, "role": "business_rules"}]}), ["sources.specs: file must be a text"]),
    "testing as text": (changed(testing="none"), ["testing: must be a mapping"]),
    "no compare": (
        changed(testing={"key_assertions": [], "expected_files": [{"file": "tests/a"}]}),
        ["testing.expected_files: field compare required"],
    ),
    "assertion no text": (
        changed(testing={"key_assertions": [1], "expected_files": []}),
        ["testing.key_assertions: every item must be a text"],
    ),
    "connections as text": (changed(connections="dev"), ["connections: must be a mapping"]),
    "connection null": (changed(connections={"oracle": None}), ["connections.oracle: must be a text"]),
    "path no text": (changed(destination={"path": 5}), ["destination.path: must be a text"]),
}


def test_every_level_of_a_manifest(spark):
    got = run_report(spark, {name: case(header) for name, (header, _) in SHAPES.items()}, SET)
    shown = {name: [m for m in got[name][0] if "unknown role" not in m] for name in SHAPES}
    assert shown == {name: messages for name, (_, messages) in SHAPES.items()}


def test_unread_registry_is_a_finding(spark):
    cases = {n: CASES[n] for n in ("fine", "absent", "mode")}
    got = run_report(spark, cases, [], "registry not found")
    assert got["fine"][0] == ["registry not found"]
    assert sorted(got["absent"][0])[-1] == "registry not found" and len(got["absent"][0]) == 2
    assert got["mode"][0] != [] and "registry not found" not in got["mode"][0]


def test_worked_job_is_fine(report):
    assert report["fine"] == ([], [])


def test_missing_manifest_stops_other_checks(report):
    assert report["missing"] == (["manifest not found"], [])


def test_no_front_matter(report):
    errors, _ = report["no block"]
    assert len(errors) == 1 and "front-matter" in errors[0]


@pytest.mark.parametrize(
    "name, part",
    [
        ("name", "Student-Download!"), ("mode", "yolo"), ("direction", "sideways"), ("format", "parquet"),
        ("role", "mystery_role"), ("misplaced role", "export"), ("unknown field", "surprise"),
        ("unknown inner field", "folder"),
    ],
)
def test_schema_errors_name_the_value(report, name, part):
    errors, _ = report[name]
    assert len(errors) == 1 and part in errors[0]


def test_all_schema_errors_together(report):
    assert len(report["three"][0]) == 3


def test_absent_file_is_named(report):
    assert report["absent"][0] == ["manifest references job/sql/export_query.sql but that file does not exist"]


def test_orphan_is_a_warning_and_tests_are_exempt(report):
    errors, warnings = report["orphan"]
    assert errors == [] and len(warnings) == 1 and "job/sql/orphan.sql" in warnings[0]


def test_unknown_connection_lists_the_registry(report):
    errors, _ = report["connection"]
    assert len(errors) == 1 and "sftp_prod" in errors[0] and str(KNOWN).replace('"', "'") in errors[0]


def test_unset_names_are_exact_and_come_with_other_problems(spark):
    cases = {"fine": case(), "absent": case(files=FILES[1:])}
    got = run_report(spark, cases, [n for n in SET if n != "ORACLE_DEV_PASSWORD"])
    unset = "Secret ORACLE_DEV_PASSWORD not configured in repo Settings → Secrets → Actions"
    assert got["fine"] == ([unset], [])
    assert len(got["absent"][0]) == 2 and unset in got["absent"][0]


def test_default_connections(spark):
    manifest = {k: v for k, v in BASE.items() if k != "connections"}
    df = manifests.parse_manifests(spark.createDataFrame([("j", json.dumps(manifest))], "job string, header string"))
    assert sorted(r.name for r in manifests.used_connections(df).collect()) == ["mule_dev", "oracle_dev", "sftp_dev"]
    bare = spark.createDataFrame([("j", json.dumps(changed(sources={"sql": []})))], "job string, header string")
    names = manifests.used_connections(manifests.parse_manifests(bare)).collect()
    assert sorted(r.name for r in names) == ["mule_repo_dev", "sftp_dev"]
    refs = manifests.referenced_files(df).orderBy("seq").collect()
    assert [r.path for r in refs] == FILES


def test_custom_checks_follow_the_rules(spark):
    df = spark.createDataFrame([(1, "F", 5), (2, "X", -1), (3, None, 0)], "k int, s string, v int")

    def negative(batch: pd.DataFrame) -> pd.Series:
        return batch["v"].map(lambda v: ["negative"] if v < 0 else [])

    out = contract.check_with(df, ["k"], ["v"], negative, [contract.one_of("s", F.col("s"), ["F"])])
    assert rows(out) == [
        (1, []), (2, ["s: 'X' is not one of ['F']", "negative"]), (3, ["s: '' is not one of ['F']"]),
    ]


def test_markers(spark):
    df = spark.createDataFrame(
        [("SELECT 1;", "ords"), ("begin ords.define_module('x')", "ords"), ("ORDS.DEFINE_ my_job", "ords"), ("any", "tests")],
        "content string, kind string",
    )
    found = contract.marker_problems(F.col("content"), F.col("kind"), {"ords": "ORDS.DEFINE_"}, F.lit("my_job"), ["ords"])
    assert [len(r.p) for r in df.select(found.alias("p")).collect()] == [2, 1, 0, 0]


def test_references_both_ways(spark):
    refs = spark.createDataFrame([("j", "a"), ("j", "b"), ("j", "b")], "job string, path string")
    present = spark.createDataFrame([("j", "a"), ("j", "c"), ("j", "tests/x")], "job string, path string")
    assert rows(references.missing_refs(refs, present, ["job", "path"])) == [("j", "b")]
    exempt = F.col("path").startswith("tests/")
    assert rows(references.unreferenced(present, refs, ["job", "path"], exempt)) == [("j", "c")]


def test_registry(spark):
    registry = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "name string")
    used = spark.createDataFrame([("x",), ("a",), (None,)], "name string")
    assert rows(references.unknown_keys(used, "name", registry)) == [("x", "['a', 'b']")]
    assert references.unknown_keys(used, "name", registry.limit(0)).count() == 2
    large = spark.range(10, 3010).select(F.col("id").cast("string").alias("name"))
    row = references.unknown_keys(used.where("name = 'x'"), "name", large).first()
    assert row.known.startswith("['10', '100', '1000', ") and row.known.endswith(", ... 3000 names in all]")


@pytest.mark.parametrize("least", ["1b", "1m"])
def test_every_known_name_is_listed(spark, folder, least):
    # More names than go into a plan, repeated and with a null, in several ranges and in one.
    names = [f"n{i % 2500}" for i in range(5000)]
    spark.createDataFrame([(n,) for n in [*names, None]], "l_linestatus string").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(1, "x"), (2, "n7"), (3, None)], "o_orderkey long, o_orderstatus string").write.parquet(
        f"{folder}/orders.parquet"
    )
    least_size = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(least_size, least)
    try:
        got = QUERIES["unknown_keys"](spark, folder).select("o_orderkey", "name", "known")
        assert rows(got) == [(1, "x", str(sorted(set(names))))]
    finally:
        spark.conf.unset(least_size)


def test_a_report_lists_every_connection(spark):
    names = sorted([*KNOWN, *(f"c{i}" for i in range(1200))])
    header, text, files = CASES["connection"]
    connections = spark.createDataFrame([(n, {}) for n in names], "name string, secrets map<string,string>")
    out = manifests.manifest_report(
        spark.createDataFrame([("j", text, header)], "job string, text string, header string"),
        spark.createDataFrame([("j", f) for f in files], "job string, path string"),
        connections, connections.select("name"),
    )
    message = f"connection 'sftp_prod' is not defined in the registry (known: {names})"
    assert rows(out) == [("j", "error", message)]


def test_long_lists_are_dealt_out(spark):
    # All uses of one unknown name leave the join in one task.
    registry = spark.range(1500).select(F.concat(F.lit("n"), "id").alias("name"))
    used = spark.range(400).select("id", F.lit("x").alias("name"))
    out = references.unknown_keys(used, "name", registry, whole=True)
    parts = out.groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert len(parts) > 1 and sum(p["count"] for p in parts) == 400


def test_known_names_join_once(spark):
    # One name fills the registry, as two line statuses fill the line items.
    registry = spark.range(3000).select(F.when(F.col("id") < 2999, "hot").otherwise("cold").alias("name"))
    used = spark.createDataFrame([("hot",), ("x",), ("x",), (None,)], "name string")
    present = used.where("name IS NOT NULL")
    declared = used.select(F.create_map(F.lit("a"), "name").alias("decl"))
    for out in (
        references.unknown_keys(used, "name", registry).select("name"),
        references.unset_required(declared.where("decl['a'] IS NOT NULL"), "decl", registry),
        references.unreferenced(present, registry, ["name"]),
    ):
        assert rows(out) == [("x",), ("x",)]
        right = out._jdf.queryExecution().optimizedPlan().toString().split("Join LeftAnti", 1)[1]
        assert "Aggregate [name" in right


def test_overlay(spark):
    base = spark.createDataFrame([("c", {"host": "h", "user": "meta", "secrets": "s"}), ("d", {"host": "i"})], "k string, b map<string,string>")
    over = spark.createDataFrame([("c", {"user": "u", "password": "p"})], "k string, o map<string,string>")
    got = {r.k: r.merged for r in references.overlay(base, over, "k", "b", "o", ["secrets"]).collect()}
    assert got == {"c": {"host": "h", "user": "u", "password": "p"}, "d": {"host": "i"}}


def test_override_may_be_null(spark):
    names = spark.createDataFrame([("a",), ("b",)], "k string")
    over = spark.createDataFrame([("a", None)], "k string, v string")
    out = references.override_or_default(names, over, "k", "v", F.lit("default"))
    assert rows(out) == [("a", None, True), ("b", "default", False)]


def test_field_map(spark):
    df = spark.createDataFrame([("S1", "x", 1)], "STUDENT_ID string, other string, n int")
    mapping = spark.createDataFrame([("n", "Number", 2), ("STUDENT_ID", "StudentId", 1)], "source string, target string, seq int")
    out = table.apply_field_map(df, mapping)
    assert out.columns == ["StudentId", "Number"] and rows(out) == [("S1", 1)]
    bad = spark.createDataFrame([("zz", "Z"), ("aa", "A")], "source string, target string")
    with pytest.raises(table.MappingError, match=r"\['aa', 'zz'\]"):
        table.apply_field_map(df, bad)


def test_change_log(spark):
    lines = "A\tsrc/new.xml\nM\tsrc/mod.xml\n\nD\told.xml\nR100\tfrom.xml\tto.xml"
    df = spark.createDataFrame([(line,) for line in lines.split("\n")], "line string")
    log = table.parse_change_log(df, "line")
    assert rows(log) == [
        ("A", "src/new.xml", None), ("D", "old.xml", None), ("M", "src/mod.xml", None), ("R", "to.xml", "from.xml"),
    ]
    assert rows(table.drop_deletes(log).select("path")) == [("src/mod.xml",), ("src/new.xml",), ("to.xml",)]


def test_external_changes(spark):
    df = spark.createDataFrame(
        [("in", ["x", "job/a"], "edit", False), ("own", ["job/a"], "done [skip ci]", False),
         ("out", ["docs/a"], "edit", False), ("manual", ["docs/a"], "go [skip ci]", True), ("null", ["job/a"], None, None)],
        "k string, paths array<string>, message string, manual boolean",
    )
    out = table.external_changes(df, "paths", "message", "job/", "[skip ci]", F.col("manual"))
    assert sorted(r.k for r in out.collect()) == ["in", "manual", "null"]


def test_canonical_order(spark):
    names = ["sql", "mulesoft", "tests"]
    df = spark.createDataFrame([("tests",), ("sql",)], "step string")
    assert [r.step for r in table.canonical_order(df, "step", names).collect()] == ["sql", "tests"]
    bad = spark.createDataFrame([("zap",), ("sql",), ("bogus",)], "step string")
    with pytest.raises(table.UnknownNames, match=r"\['bogus', 'zap'\]"):
        table.canonical_order(bad, "step", names)


def test_pages(spark):
    df = spark.range(1, 1001).select(F.col("id").alias("k")).repartition(4)
    paged = table.paginate(df, ["k"], 300)
    assert rows(paged.groupBy("page").count()) == [(1, 300), (2, 300), (3, 300), (4, 100)]
    third = table.page(df, ["k"], 3, 300)
    assert sorted(r.k for r in third.collect()) == list(range(601, 901))
    assert table.page(df, ["k"], 9, 300).count() == 0
    tied = df.select(F.lit(1).alias("t"), "k")
    pages = [table.page(tied.repartition(n + 1, "k"), ["t"], n, 250) for n in (1, 2, 3, 4)]
    assert [sorted(r.k for r in p.collect()) for p in pages] == [
        list(range(250 * n + 1, 250 * n + 251)) for n in range(4)
    ]
    with pytest.raises(ValueError):
        table.page(df, ["k"], 0, 10)


def test_markdown_table(spark):
    df = spark.createDataFrame([(1, "STUDENT_ID", "StudentId"), (2, "X", None)], "n int, source string, target string")
    lines = [r.line for r in table.markdown_table(df, "map", ["source", "target"], "n").collect()]
    assert lines == ["### Sheet: map", "| source | target |", "|---|---|", "| STUDENT_ID | StudentId |", "| X |  |"]
    assert table.markdown_table(df.where("n > 9"), "map", ["source", "target"], "n").count() == 0


def test_overlay_without_a_base(spark):
    from pyspark.sql import functions as F

    from tablehandoff.operators.references import merge_maps

    df = spark.createDataFrame(
        [(1, None, {"a": "1"}), (2, {"b": "2"}, None), (3, None, None), (4, {"a": "0", "b": "2"}, {"a": "1"})],
        "id int, base map<string,string>, over map<string,string>",
    )
    got = {r.id: r.m for r in df.select("id", merge_maps(F.col("base"), F.col("over")).alias("m")).collect()}
    assert got == {1: {"a": "1"}, 2: {"b": "2"}, 3: None, 4: {"a": "1", "b": "2"}}
