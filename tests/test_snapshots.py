"""Fingerprints, differences and the routing scenarios."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablehandoff.operators import snapshots
from tablehandoff.plans import decisions, manifests

HASHES = "job string, path string, hash string"
MANIFEST_PATH = "job/intent.md"
BASE = {
    "job_name": "student_download_v1",
    "mode": "generate",
    "direction": "download",
    "sources": {
        "sql": [
            {"file": "sql/load_staging.sql", "role": "staging_load"},
            {"file": "sql/export_query.sql", "role": "export"},
        ],
        "samples": [{"file": "samples/expected_output.csv", "role": "output_example"}],
    },
    "destination": {
        "connection": "sftp_dev", "path": "/incoming/student/", "file_format": "csv",
        "file_name_pattern": "student_{yyyymmdd}.csv",
    },
    "connections": {"oracle": "oracle_dev", "mulesoft": "mule_repo_dev"},
    "testing": {"expected_row_logic": "row count equals staging", "key_assertions": ["a"]},
}
FILES = {
    "intent.md": "0", "sql/load_staging.sql": "1", "sql/export_query.sql": "2",
    "samples/expected_output.csv": "3",
}
ALL = {"ords", "mulesoft", "tests"}


def changed(**fields):
    out = json.loads(json.dumps(BASE))
    for name, value in fields.items():
        if isinstance(value, dict) and isinstance(out.get(name), dict):
            out[name].update(value)
        else:
            out[name] = value
    return out


def decide(spark, scenarios):
    """{(job, item): state}: every scenario is a job of its own, all in one query."""

    def case(new=BASE, files=FILES, old=BASE, old_files=FILES, first=False, records=ALL):
        return new, files, old, old_files, first, records

    cases = {name: case(**change) for name, (change, _) in scenarios.items()}

    def table(schema, cells):
        return spark.createDataFrame([(j, *c) for j, one in cases.items() for c in cells(*one)], schema)

    def hashes(mine):
        return [(f"job/{p}" if p == "intent.md" else p, h) for p, h in mine.items()]

    def parsed(cells):
        return manifests.parse_manifests(table("job string, header string", cells))

    now = parsed(lambda new, *_: [(json.dumps(new),)])
    before = parsed(lambda new, files, old, *_: [(json.dumps(old),)])
    items = "job string, item string"
    out = decisions.affected_outputs(
        table("job string, first_run boolean", lambda *c: [(c[4],)]),
        table(items, lambda new, *_: [(i,) for i in (ALL if new["sources"].get("sql") else ALL - {"ords"})]),
        table(items, lambda *c: [(i,) for i in c[5]]),
        table(HASHES, lambda *c: hashes(c[3])),
        table(HASHES, lambda *c: hashes(c[1])),
        manifests.reference_categories(now),
        manifests.manifest_fields(before), manifests.manifest_fields(now),
        manifest_path=MANIFEST_PATH,
    )
    return {(r.job, r.item): r.state for r in out.collect()}


SCENARIOS = {
    "first run": (dict(first=True, records=()), ALL),
    "nothing": ({}, set()),
    "mode flip": (dict(new=changed(mode="deploy"), files={**FILES, "intent.md": "x"}), set()),
    "sql file": (dict(files={**FILES, "sql/load_staging.sql": "x"}), {"ords", "tests"}),
    "destination path": (dict(new=changed(destination={"path": "/x/"})), {"mulesoft", "tests"}),
    "format and name": (
        dict(new=changed(destination={"file_format": "json", "file_name_pattern": "x.json"})),
        {"mulesoft", "tests"},
    ),
    "new spec": (
        dict(
            new=changed(sources={"specs": [{"file": "specs/brd.txt", "role": "business_rules"}]}),
            files={**FILES, "specs/brd.txt": "s"},
        ),
        ALL,
    ),
    "delivery block": (dict(new=changed(mulesoft_delivery={"repo": "r"})), {"mulesoft", "tests"}),
    "testing text": (dict(new=changed(testing={"expected_row_logic": "else"})), {"tests"}),
    "new test file": (dict(files={**FILES, "tests/golden.csv": "g"}), {"tests"}),
    "output deleted": (dict(records={"ords", "tests"}), {"mulesoft"}),
    "sample": (dict(files={**FILES, "samples/expected_output.csv": "x"}), {"mulesoft", "tests"}),
    "job renamed": (dict(new=changed(job_name="other_v1")), ALL),
    "unknown path": (dict(files={**FILES, "odd/file.bin": "x"}), ALL),
    "unreferenced mapping": (dict(files={**FILES, "mappings/m.xlsx": "x"}), {"mulesoft", "tests"}),
    "null equals absent": (dict(new=changed(mulesoft_delivery=None)), set()),
    "no sql, first run": (
        dict(new=changed(sources={"sql": []}), old=changed(sources={"sql": []}), first=True),
        {"mulesoft", "tests"},
    ),
}


@pytest.fixture(scope="module")
def decided(spark):
    return decide(spark, SCENARIOS)


@pytest.mark.parametrize("name", SCENARIOS)
def test_scenario(decided, name):
    got = {i for i in ALL if decided[name, i] == "stale"}
    assert got == SCENARIOS[name][1]
    assert len(decided) == 3 * len(SCENARIOS)


def test_not_applicable_is_its_own_state(spark):
    no_sql = changed(sources={"sql": []})
    jobs = spark.createDataFrame([("j", False)], "job string, first_run boolean")
    none = spark.createDataFrame([], HASHES)
    out = decisions.affected_outputs(
        jobs, spark.createDataFrame([("j", "tests")], "job string, item string"),
        spark.createDataFrame([("j", "tests")], "job string, item string"), none, none,
        spark.createDataFrame([], "job string, path string, category string"),
    )
    assert no_sql["sources"]["sql"] == []
    assert {r.item: r.state for r in out.collect()} == {
        "ords": "not applicable", "mulesoft": "not applicable", "tests": "current",
    }


def reference_digest(pairs):
    digest = hashlib.sha256()
    for path, value in sorted(pairs.items()):
        digest.update(path.encode() + b"\0" + value.encode() + b"\0")
    return "sha256:" + digest.hexdigest()


def test_fingerprint_forms(spark):
    hot = {f"p{i}": f"h{i}" for i in range(60)}
    cold = {"b": "2", "a": "1", "ä": "3"}
    data = [("hot", k, v) for k, v in hot.items()] + [("cold", k, v) for k, v in cold.items()]
    df = spark.createDataFrame(data, HASHES)
    edited = df.withColumn("hash", F.when(F.col("path") == "p7", "x").otherwise(F.col("hash")))
    for form in (snapshots.EXACT, snapshots.SUM):

        def prints(rows):
            return {r.job: r for r in snapshots.fingerprint(rows, ["job"], "path", "hash", form).collect()}

        got = prints(df)
        assert {j: (r.form, r.n) for j, r in got.items()} == {"cold": (form, 3), "hot": (form, 60)}
        again = prints(df.repartition(7).orderBy(F.desc("path")))
        assert {j: r.fingerprint for j, r in again.items()} == {j: r.fingerprint for j, r in got.items()}
        after = prints(edited)
        assert {j: r.fingerprint == got[j].fingerprint for j, r in after.items()} == {"hot": False, "cold": True}
        if form == snapshots.EXACT:
            assert got["cold"].fingerprint == reference_digest(cold)
            assert got["hot"].fingerprint == reference_digest(hot)
    with pytest.raises(ValueError):
        snapshots.fingerprint(df, ["job"], "path", "hash", "other")


def test_snapshot_diff_with_nulls_and_copies(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None), ("d", None), ("e", "5")], "k string, h string")
    new = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", None), ("d", "4"), ("f", None)], "k string, h string")
    want = [("b", "modified"), ("d", "modified"), ("e", "removed"), ("f", "added")]
    assert rows(snapshots.snapshot_diff(old, new, ["k"], "h")) == want
    # Copies of a key do not multiply.
    copies = snapshots.snapshot_diff(old.unionByName(old), new.unionByName(new), ["k"], "h")
    assert rows(copies) == want


def test_classify_prefers_references(spark):
    paths = spark.createDataFrame(
        [("j", p) for p in ("sql/a", "tests/a", "docs/x", "tests", "sql", "own/ref")], "job string, path string"
    )
    refs = spark.createDataFrame(
        [("j", "own/ref", "samples"), ("j", "own/ref", "sql"), ("k", "docs/x", "sql"), ("j", "tests/a", "samples")],
        "job string, path string, category string",
    )
    got = {r.path: r.category for r in snapshots.classify(paths, refs, ["job"]).collect()}
    assert got == {
        "sql/a": "sql", "tests/a": "samples", "docs/x": "specs", "tests": "specs", "sql": "sql", "own/ref": "sql",
    }


def test_label_actions(spark):
    data = [
        ("first", "ords", "stale", False, False), ("first", "mulesoft", "stale", False, False),
        ("first", "tests", "stale", False, False), ("target", "mulesoft", "stale", False, True),
        ("deploy", "tests", "current", True, False), ("deploy", "ords", "current", True, False),
        ("nosql", "ords", "not applicable", False, False), ("quiet", "tests", "current", False, True),
        ("quiet", "mulesoft", "current", False, True),
    ]
    df = spark.createDataFrame(data, "job string, item string, state string, deploy boolean, target boolean")
    rules = decisions.plan_rules(F.col("item"), F.col("state"), F.col("deploy"), F.col("target"))
    got = {(r.job, r.item): r.action for r in decisions.label_actions(df, ["job", "item"], rules).collect()}
    assert got == {
        ("first", "ords"): "generate", ("first", "mulesoft"): "generate-new-flow", ("first", "tests"): "generate",
        ("target", "mulesoft"): "workspace-edit", ("deploy", "tests"): "run-tests", ("deploy", "ords"): "skip",
        ("nosql", "ords"): "skip", ("quiet", "tests"): "skip", ("quiet", "mulesoft"): "skip",
    }


def test_building_one_output_keeps_the_others_stale(spark):
    affected = spark.createDataFrame([("j", "ords", "stale"), ("j", "tests", "stale")], "job string, item string, state string")
    built = spark.createDataFrame([("j", "ords")], "job string, item string")
    prints = spark.createDataFrame([("j", "fp2")], "job string, fingerprint string")
    assert rows(decisions.record_built(affected, prints, built)) == [("j", "ords", "fp2")]


def test_switch_to_deploy_still_delivers(spark):
    df = spark.createDataFrame(
        [("built", "current", True, "f", None), ("done", "current", True, "f", "f"),
         ("review", "current", False, "f", None), ("n/a", "not applicable", True, "f", None)],
        "job string, state string, deploy boolean, built string, delivered string",
    )
    c = decisions.needs_delivery(F.col("state"), F.col("deploy"), F.col("built"), F.col("delivered"))
    assert [r.job for r in df.where(c).collect()] == ["built"]


def plain_tree(lines):
    """The digest of digests of (key, value) rows, in plain Python."""
    rows_of = {}
    for k, v in lines:
        cells = "".join(("\1" if c is None else c) + "\0" for c in (k, v))
        digest = hashlib.sha256(cells.encode()).hexdigest()
        rows_of[digest] = rows_of.get(digest, 0) + 1
    entries = {d: f"{d}:{n};" for d, n in rows_of.items()}
    for digits in (6, 3, 0):
        below = {}
        for start, entry in entries.items():
            below.setdefault(start[:digits], []).append(entry)
        entries = {s: f"{s}:{hashlib.sha256(''.join(sorted(e)).encode()).hexdigest()};" for s, e in below.items()}
    return "sha256:" + entries[""][1:-1]


def test_fingerprint_tree(spark):
    lines = [("hot", f"k{i % 700}", f"h{i % 650}") for i in range(3000)] + [("hot", "copy", "h")] * 2000
    lines += [("one", "k", "h"), ("null", None, "h"), ("null", "", "h"), ("empty", "", "h"), ("empty", "", "h"), (None, "k", None)]
    df = spark.createDataFrame(lines, "g string, k string, v string")
    found = [
        {r.g: (r.n, r.form, r.fingerprint) for r in snapshots.fingerprint(x, ["g"], "k", "v", snapshots.TREE).collect()}
        for x in (df.repartition(7), df.coalesce(1), df.orderBy(F.desc("v")).repartition(3, "g"))
    ]
    assert found[0] == found[1] == found[2]
    for g in {x[0] for x in lines}:
        own = [x[1:] for x in lines if x[0] == g]
        assert found[0][g] == (len(own), "tree", plain_tree(own))
    assert len({f[2] for f in found[0].values()}) == 5


def test_fingerprint_tree_spreads_a_hot_group(spark):
    df = spark.range(50_000).select(F.lit("hot").alias("g"), F.col("id").cast("string").alias("k"), F.lit("h").alias("v"))
    leaves = snapshots._tree_node(
        df.groupBy("g", F.sha2("k", 256).alias("_row")).agg(F.count(F.lit(1)).alias("n")), ["g"], snapshots.LEAF_DIGITS, F.col("_row")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = leaves.groupBy(F.spark_partition_id()).agg(F.sum("n").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert leaves.agg(F.max("n")).first()[0] <= 5 and len(sizes) == 4 and max(r.n for r in sizes) < 15_000


def test_unknown_form(spark):
    with pytest.raises(ValueError):
        snapshots.fingerprint(spark.createDataFrame([("a", "b", "c")], "g string, k string, v string"), ["g"], "k", "v", "other")
