"""Long repeats against a count of all windows."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import types as T

from tablehandoff.llm.repeats import remove_repeats


def brute(texts, width):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def check(spark, texts, width=35):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("row", T.StringType()), T.StructField("n_words", T.StringType())])
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], schema).repartition(3)
    df.write.mode("overwrite").parquet(check.folder)
    got = remove_repeats(spark.read.parquet(check.folder), width=width)
    assert got.columns == ["doc_id", "text", "row", "n_words", "n_removed", "kept_text"]
    rows = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got.collect()}
    want = brute(texts, width)
    assert [rows[i] for i in range(len(texts))] == want
    assert {r.doc_id: r.text for r in got.select("doc_id", "text").collect()} == dict(enumerate(texts))


@pytest.fixture(autouse=True)
def place(folder):
    check.folder = folder + "/docs"


def words(seed, n):
    return [hashlib.md5(f"{seed}-{i}".encode()).hexdigest()[:4] for i in range(n)]


def test_spans_edges_and_nulls(spark):
    a, b, c = words("a", 200), words("b", 150), words("c", 90)
    texts = [
        " ".join(a), " ".join(b + a[20:100]), "\n".join(c[:40] + a[60:94] + c[40:]),
        " ".join(c[:10] + a[150:185] + c[50:]), " ".join(b), " ".join(b), None, "", "  \t\n", " ".join(a[:35]),
        " ".join(a[:34]), " ".join(b[:70] + ["changed"] + b[71:]), "é ü " * 80, "same " * 500,
        " ".join(words("x", 5)), "one two three " * 30 + " ".join(a[100:140]) + " one two three" * 20,
    ]
    check(spark, texts)


def test_small_widths(spark):
    texts = ["a b c a b c a b", "b c a", "", None, "x y", "x y z"]
    for width in (1, 2, 3):
        check(spark, texts, width)


def test_many_ends(spark):
    passage = words("p", 50)
    texts = [" ".join(words(f"l{i}", i % 7 + 3) + passage[i % 5 : 50 - i % 3] + words(f"r{i}", 60)) for i in range(120)]
    check(spark, texts + texts[:5])


def test_empty_table(spark):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(check.folder)
    assert remove_repeats(spark.read.parquet(check.folder)).count() == 0


def test_long_texts_in_pieces(spark, monkeypatch):
    import numpy as np

    from tablehandoff.llm import repeats
    from tablehandoff.llm.words import Words

    text = " ".join(words("q", 500) + words("q", 120)).encode()
    made = Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    monkeypatch.setattr(repeats, "PIECE", 64)
    windows = []
    for a, b in repeats._pieces(made, 35):
        first, count, _, _ = repeats._zones(made.hashes[a:b], np.zeros(b - a, int), 35)
        windows += [a + f + i for f, n in zip(first, count) for i in range(n)]
    assert sorted(windows) == list(range(len(made.hashes) - 34))
