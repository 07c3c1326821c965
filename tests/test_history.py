"""Histories, sections and the sensitive-value scan against plain Python."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tablehandoff.operators import history, sections, sensitive
from tablehandoff.operators.render import render_with


@pytest.fixture
def versions(spark):
    # Key h holds most rows; equal times are told apart by the id.
    data = [("h" if i % 3 else f"k{i % 4}", i // 2, i, f"id{i}" if i % 5 else "") for i in range(90)]
    random.Random(1).shuffle(data)
    return spark.createDataFrame(data, "k string, ts int, id int, sha string"), data


def newest(data):
    out = {}
    for r in sorted(data, key=lambda r: (r[1], r[2]), reverse=True):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("top_limit", [1000, 0])
def test_capped_history(versions, top_limit, monkeypatch):
    monkeypatch.setattr(history, "TOP_LIMIT", top_limit)
    df, data = versions
    got = history.capped_history(df, ["k"], ["ts", "id"])
    want = [(*r, i) for rs in newest(data).values() for i, r in enumerate(rs[:10])]
    assert rows(got) == sorted(want, key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("n", [0, 3, 20])
@pytest.mark.parametrize("deep", [False, True])
def test_version_at(spark, versions, n, deep, monkeypatch):
    if deep:
        monkeypatch.setattr(history, "TOP_LIMIT", 0)
    df, data = versions
    wanted = spark.createDataFrame([("h",), ("k0",), ("nobody",)], "k string")
    got = {r.k: r for r in history.version_at(df, ["k"], ["ts", "id"], n, "sha", wanted).collect()}
    for key in ("h", "k0"):
        mine = newest(data)[key]
        if n >= len(mine):
            assert got[key].status == "out of range" and got[key].id is None
        else:
            assert got[key].id == mine[n][2]
            assert got[key].status == ("found" if mine[n][3] else "no id")
        assert got[key].versions == len(mine)
    assert (got["nobody"].status, got["nobody"].versions) == ("no history", 0)


@pytest.mark.parametrize("limit", [5, 1000])
def test_intervals(spark, versions, limit):
    df, data = versions
    got = history.version_intervals(df, ["k"], ["ts", "id"], "ts", limit)
    want = []
    for rs in newest(data).values():
        later = None
        for r in rs:
            want.append((*r, later[1] if later else None, later is not None))
            later = r
    assert rows(got) == sorted(want, key=lambda r: tuple(map(str, r)))


def test_archived_is_versions_minus_one(spark):
    df = spark.createDataFrame([("j", 1), ("j", 2), ("j", 3)], "k string, ts int")
    assert history.version_intervals(df, ["k"], ["ts"], "ts").where("archived").count() == 2


def test_fifteen_pushes_keep_ten(spark):
    df = spark.range(15).select(F.lit("j").alias("k"), F.col("id").alias("ts"))
    kept = history.capped_history(df, ["k"], ["ts"]).orderBy("version").collect()
    assert [r.ts for r in kept] == list(range(14, 4, -1))


def test_latest_patch_and_first(spark, versions):
    df, data = versions
    latest = {r.k: r.id for r in history.latest_per_key(df, ["k"], ["ts", "id"]).collect()}
    assert latest == {k: rs[0][2] for k, rs in newest(data).items()}
    patched = history.patch_latest(df, ["k"], ["ts", "id"], "sha", F.lit("new"))
    assert {r.id for r in patched.where("sha = 'new'").collect()} == set(latest.values())
    assert patched.count() == len(data) and patched.columns == df.columns
    first = [r.k for r in history.dedupe_first_seen(df, ["k"], ["ts", "id"]).collect()]
    oldest = {k: rs[-1] for k, rs in newest(data).items()}
    assert first == sorted(oldest, key=lambda k: oldest[k][1:3])


def test_counts_include_zero(spark, versions):
    df, data = versions
    keys = spark.createDataFrame([("h",), ("none",)], "k string")
    assert rows(history.history_counts(keys, df, ["k"])) == [("h", 60), ("none", 0)]


def test_corpus_parts(spark):
    data = [("g", f"p{i:02d}", "x" * (i % 7)) for i in range(40)] + [("s", "b.txt", " two \n"), ("s", "a.txt", "one")]
    df = spark.createDataFrame(data, "g string, path string, text string").repartition(4)
    whole = {}
    for g, p, t in sorted(data):
        if t.strip():
            whole.setdefault(g, []).append(f"### {p}\n\n{t.strip()}")
    want = {g: "\n\n".join(blocks) for g, blocks in whole.items()}
    for size in (50, 10_000):
        got = sections.concat_corpus(df, ["g"], "path", "text", part_chars=size).orderBy("g", "part").collect()
        assert {g: "\n\n".join(r.text for r in got if r.g == g) for g in want} == want
        assert max(len(r.text) for r in got) < size + 40
        assert len([r for r in got if r.g == "g"]) == (1 if size > 50 else len({r.part for r in got if r.g == "g"}))
        assert [r.part for r in got if r.g == "s"] == [0]


def test_sections_over_the_cap_are_problems(spark):
    data = [
        ("j", "samples", 0, "c", "3"), ("j", "sql", 1, "b", "2"), ("j", "sql", 0, "a", "1"), ("k", "odd", 0, "z", "9"), ("k", "sql", 0, "a", "1"),
        ("big", "sql", 0, "a", "x" * 48_000),
    ]
    df = spark.createDataFrame(data, "job string, kind string, seq int, title string, body string")
    got = {r.job: r for r in sections.group_sections(df, ["job"], "kind", "seq", "title", "body").collect()}
    blocks = [f"\n## {t}\n```\n{b}\n```" for t, b in (("a", "1"), ("b", "2"), ("c", "3"))]
    assert got["j"].text == "\n".join(blocks) and got["j"].problem is None
    assert got["j"].chars == len(got["j"].text) and got["j"].sections == 3
    assert got["big"].text is None and "over the 48000-char cap" in got["big"].problem
    assert got["k"].text is None and got["k"].problem == "unlisted section kind: odd"


def test_section_cap_is_strict(spark):
    overhead = len("\n## t\n```\n\n```")
    for extra, fits in ((0, True), (1, False)):
        df = spark.createDataFrame([("j", "sql", 0, "t", "x" * (100 - overhead + extra))], "job string, kind string, seq int, title string, body string")
        row = sections.group_sections(df, ["job"], "kind", "seq", "title", "body", cap=100).first()
        assert (row.text is not None) is fits and row.chars == 100 + extra


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text("abé ", max_size=12), min_size=1, max_size=8),
    st.lists(st.text("abé ", max_size=3), max_size=6),
    st.sampled_from([3, 1 << 22]),
)
def test_scan_equals_brute_force(spark, texts, values, size):
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    table = spark.createDataFrame([(f"n{i}", v) for i, v in enumerate(values)], "name string, value string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(sensitive, "SLICE_BYTES", size)
        found = sensitive.sensitive_scan(docs, "id", "text", table, "name", "value").collect()
    want = sorted((i, f"n{j}") for i, t in enumerate(texts) for j, v in enumerate(values) if v and v in t)
    assert sorted(tuple(r) for r in found) == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text("ab ", max_size=40), min_size=1, max_size=8),
    st.lists(st.tuples(st.integers(0, 7), st.integers(0, 30), st.integers(1, 20)), max_size=6),
)
def test_scan_of_many_words_equals_brute_force(spark, texts, cuts):
    values = [texts[i % len(texts)][a : a + n] for i, a, n in cuts] + ["a b a b a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    table = spark.createDataFrame([(f"n{i}", v) for i, v in enumerate(values)], "name string, value string")
    found = sensitive.sensitive_scan(docs, "id", "text", table, "name", "value")
    want = sorted((i, f"n{j}") for i, t in enumerate(texts) for j, v in enumerate(values) if v and v in t)
    assert sorted(tuple(r) for r in found.collect()) == want


def test_scan_names_only(spark):
    docs = spark.createDataFrame([("f", "x test-password y"), ("g", None)], "path string, text string")
    values = spark.createDataFrame([("ORACLE_DEV_PASSWORD", "test-password"), ("EMPTY", "")], "name string, value string")
    found = sensitive.sensitive_scan(docs, "path", "text", values, "name", "value")
    assert rows(found) == [("f", "ORACLE_DEV_PASSWORD")]
    assert "test-password" not in found._jdf.queryExecution().toString()


def test_scan_joins_by_anchor(spark):
    draw = random.Random(2)

    def word(n):
        return "".join(draw.choice("abcdeé") for _ in range(n))

    values = [(f"n{i}", word(draw.choice([1, 3, 5, 9, 17, 40, 200]))) for i in range(300)] + [("n0", "twice"), ("same", "twice"), (None, "no name")]
    body = [" ".join(word(draw.randint(1, 60)) for _ in range(20)) for _ in range(150)]
    for i in range(0, 150, 2):
        body[i] += "".join(v for _, v in draw.sample(values, 3))
    body += ["twice twice " * 2000, "", None, values[0][1], "x" * 500_000 + values[5][1]]
    docs = [(i if i % 9 else None, t) for i, t in enumerate(body)]
    df = spark.createDataFrame(docs, "id int, text string").repartition(3)
    table = spark.createDataFrame(values + [("none", None), ("empty", "")], "name string, value string").repartition(2)
    found = sensitive.sensitive_scan(df, "id", "text", table, "name", "value")
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = sorted((str(i), str(n)) for i, t in docs if t for n in {n for n, v in values if v in t})
    assert sorted((str(r.id), str(r.name)) for r in found.collect()) == want


def test_scan_without_values(spark):
    docs = spark.createDataFrame([(1, "x")], "id int, text string")
    for values in ([], [("a", ""), ("b", None)]):
        table = spark.createDataFrame(values, "name string, value string")
        found = sensitive.sensitive_scan(docs, "id", "text", table, "name", "value")
        assert found.columns == ["id", "name"] and found.count() == 0


def test_render(spark):
    data = [("a", i, f"v{i}") for i in range(25)] + [("b", 1, "x")]
    df = spark.createDataFrame(data, "file string, n int, v string").repartition(3)

    def lines(records):
        return "".join(f"{r['n']:03d}{r['v']}\n" for r in records).encode()

    whole = {r.file: bytes(r.content) for r in render_with(df, lines, "file", ["n"], rows_per_part=100).collect()}
    assert whole == {"a": lines([{"n": i, "v": f"v{i}"} for i in range(25)]), "b": b"001x\n"}
    parts = render_with(df, lines, "file", ["n"], rows_per_part=10).orderBy("file", "part").collect()
    assert [r.part for r in parts] == [0, 1, 2, 0]
    assert b"".join(bytes(r.content) for r in parts if r.file == "a") == whole["a"]
