"""Whitened rows against numpy on the collected matrix."""

import math

import numpy as np
import pytest

from tablehandoff.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n int, component string, `odd ``name` int"


def brute(vectors, components=8):
    x = np.floor(1024 * np.array(vectors, dtype=np.float32).astype(np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    exact = [sum(int(n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return exact, np.abs(centred @ vectors[:, order] / np.sqrt(values[order])), values[order] / values.sum()


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 2) for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("block_rows", [7, 1024])
def test_against_numpy(spark, block_rows):
    draw = np.random.default_rng(1)
    mixing = draw.normal(size=(12, 12))
    good = [(i, (draw.normal(size=12) @ mixing + 3).tolist()) for i in range(150)]
    good += [(9, good[0][1])] * 60 + [(None, good[1][1])]  # a hot vector, repeated ids, a null id
    bad = [(500, None), (501, []), (502, [1.0] * 5), (503, [None, *[1.0] * 11]), (504, [math.nan, *[1.0] * 11]),
           (505, [math.inf, *[1.0] * 11]), (506, [1e30, *[1.0] * 11])]
    got = whitening.whiten(frame(spark, good + bad), block_rows=block_rows)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"]
    got = got.collect()
    exact, white, explained = brute([v for _, v in good])
    assert len(got) == 8 * len(good) and {r.n for r in got} == {len(good)} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    want = sorted((str(i), c + 1, e, round(float(z), 7)) for (i, _), e, row in zip(good, exact, white) for c, z in enumerate(row))
    assert sorted((str(r.vec_id), r.component, r.deviation, round(abs(r.whitened), 7)) for r in got) == want
    assert all(r.deviation == int(r.deviation_exact) and abs(r.explained / explained[r.component - 1] - 1) < 1e-9 for r in got)
    whole = np.array([r.whitened for r in sorted(got, key=lambda r: (r.component, str(r.vec_id), r.deviation))]).reshape(8, -1)
    assert np.abs(whole @ whole.T / len(good) - np.eye(8)).max() < 1e-9  # one sign for all rows


def test_deviation_beyond_a_long(spark):
    rows = [(i, [(-1.0) ** i * 1e6, float(i % 3)]) for i in range(200)]
    got = whitening.whiten(frame(spark, rows)).collect()
    exact = brute([v for _, v in rows])[0]
    assert min(exact) > 2**63 and {int(r.deviation_exact) for r in got} == set(exact) and {r.deviation for r in got} == {None}


def test_fewer_components_and_none(spark):
    few = whitening.whiten(frame(spark, [(0, [0.0, 0.0, 1.0]), (1, [1.0, 0.0, 1.0]), (2, [2.0, 1.0, 1.0])])).collect()
    assert {r.component for r in few} == {1, 2} and len(few) == 6
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]):
        empty = whitening.whiten(frame(spark, rows))
        assert empty.count() == 0 and len(empty.columns) == 8
