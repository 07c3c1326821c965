"""Sequences against the ids of the documents; plans on many histograms."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tablehandoff.llm import packing
from tablehandoff.llm.queries import BYTES

COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def laid(histogram, size):
    made = packing.plan(histogram, size)
    sequences, whole = {}, 0
    for length, n in histogram.items():
        for rank in range(n):
            pieces = list(packing.places(made, length, rank))
            assert sum(p[1] for p in pieces) == length and [p[0] for p in pieces] == list(np.cumsum([0, *[p[1] for p in pieces]])[:-1])
            whole += len(pieces) == 1
            for _, ids, sequence, offset in pieces:
                sequences.setdefault(sequence, []).append((offset, ids))
    lengths = []
    for parts in sequences.values():
        end = 0
        for offset, ids in sorted(parts):
            assert offset == end
            end += ids
        lengths.append(end)
    assert sorted(sequences) == list(range(made.sequences)) and all(x <= size for x in lengths)
    assert sum(x < size for x in lengths) <= 1
    return whole


@pytest.mark.parametrize("size", [2, 4, 16, 64])
def test_plans(size):
    draw = random.Random(size)
    for _ in range(30):
        lengths = draw.sample(range(1, size), draw.randint(1, size - 1))
        laid({x: draw.choice([1, draw.randint(1, 60)]) for x in lengths}, size)


def test_rests_that_do_not_fit_are_cut_and_others_are_not():
    laid({600: 1000}, 1024)
    laid({}, 1024), laid({1: 1}, 1024)
    assert laid({700: 5000, 324: 5000}, 1024) == 10_000
    draw = random.Random(1)
    wide = {x: draw.randint(1, 300) for x in range(1, 1024)}
    assert laid(wide, 1024) > 0.98 * sum(wide.values())


def test_column_generation_reaches_the_bound():
    # Longest first puts 6 with 3; the least number of sequences needs 6 + 4 and 3 + 3 + 4.
    lengths, demand = np.array([3, 4, 6]), np.array([200, 200, 100])
    patterns, used = packing.cover(lengths, demand, 10, gap=0)
    assert abs(used.sum() - (lengths @ demand) / 10) < 1e-3
    assert np.allclose(used @ patterns, demand, atol=1e-3) and (patterns @ lengths <= 10).all()


def holds(got, rows, size):
    model = Tokenizer.from_file(BYTES)
    want = {i: [*model.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    by, sequences = {}, {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by) == set(want)
    for i, pieces in by.items():
        end = 0
        for r in sorted(pieces, key=lambda r: r.start):
            ids = np.array(want[i][r.start : r.start + r.length], dtype="<u4")
            assert r.start == end and r.doc_tokens == len(want[i]) and r.ids_crc32 == zlib.crc32(ids.tobytes())
            end += r.length
        assert end == len(want[i])
    short = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
        short += end < size
    assert short <= 1 and sorted(sequences) == list(range(len(sequences)))


@pytest.mark.parametrize("size", [16, 1024])
def test_documents(spark, folder, monkeypatch, size):
    monkeypatch.setattr(packing, "SLICE_BYTES", 5000)
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choice(["the", "of", "Wort", "été,", "x<|endoftext|>"]) for _ in range(draw.randint(0, 400)))) for i in range(150)]
    rows += [(1000 + i, "copy of one text") for i in range(100)] + [(2000, None), (2001, ""), (2002, "long words " * 20_000), (None, "no key")]
    df = spark.createDataFrame([(i, t, 1, "p") for i, t in rows], "doc_id long, text string, rest int, `part` string").repartition(4)
    got = packing.pack(df, BYTES, size)
    assert got.columns == COLUMNS
    holds(got.collect(), rows, size)


def test_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([("a", "one row")] * 50, "doc_id string, text string")
    got = packing.pack(df, BYTES, 8).collect()
    assert sum(r.length for r in got) == 50 * 3 and {r.doc_tokens for r in got} == {3}
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), BYTES).count() == 0
