"""Near copies against all pairs; unbiased signatures; components."""

import random
from collections import Counter

import numpy as np
import pytest

from tablehandoff.llm import neardup
from tablehandoff.llm.components import components


def bag(text):
    w = (text or "").split()
    n = min(5, len(w))
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def brute(texts, least=0.8):
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    made = [bag(t) for t in texts]
    for i, x in enumerate(made):
        for j in range(i):
            y = made[j]
            if x and y and sum((x & y).values()) >= least * sum((x | y).values()) - 1e-12:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(texts))]


def corpus():
    rng = random.Random(3)
    words = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    texts = []
    passage = words(50)
    for _ in range(40):
        base = words(rng.choice([3, 5, 12, 60, 150, 300]))
        for _ in range(rng.choice([1, 2, 5])):
            part = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                at = rng.randrange(len(part))
                part[at : at + 1] = rng.choice([[], ["new"], ["new", part[at]]]) if len(part) > 3 else [part[at]]
            texts.append(" ".join(part))
    texts += [" ".join(words(40) + passage + words(30)) for _ in range(30)]
    # Bags that differ in how often a shingle occurs only, and a chain of near copies.
    texts += ["a b c d e " * n for n in (10, 11, 13, 20, 40)]
    chain = words(200)
    for i in range(12):
        texts.append(" ".join(chain))
        chain = chain[:]
        chain[i * 15] = f"changed{i}"
    return texts + [None, "", "  \n", "one", "one", None, "x " * 30_000]


@pytest.mark.parametrize("name", ["doc_id", "odd `name`.x"])
def test_against_all_pairs(spark, folder, name):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "r", 7) for i, t in enumerate(texts)], "id long, text string, row string, root int")
    df = df.withColumnRenamed("id", name).repartition(3)
    df.write.parquet(folder + "/d")
    docs = spark.read.parquet(folder + "/d")
    got = {r.doc_id: r for r in neardup.near_duplicates(docs, doc_id=name).collect()}
    want = brute(texts)
    assert [got[i].class_id for i in range(len(texts))] == want
    kept = [r for r in got.values() if r.keeps]
    assert len(kept) == len(set(want)) == len({r.class_id for r in kept})
    left = neardup.without_copies(docs)
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    assert left.count() == len(set(want))


def test_repeated_rows_null_ids_and_empty(spark, folder):
    rows = [(5, "same text of six words here")] * 4 + [(None, "same text of six words here"), (None, "other"), (6, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(folder + "/d")
    got = neardup.near_duplicates(spark.read.parquet(folder + "/d")).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == {(5, 5): 4, (None, 5): 1, (None, None): 1, (6, 6): 1}
    assert sum(r.keeps for r in got) == 3
    spark.createDataFrame([], "doc_id long, text string").write.parquet(folder + "/e")
    assert neardup.near_duplicates(spark.read.parquet(folder + "/e")).count() == 0


def test_signatures_are_unbiased():
    """Agreement of slots against the weighted Jaccard similarity, weights 1 to 9."""
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    x, y = rng.integers(1, 10, 60), rng.integers(0, 10, 60)
    text = np.concatenate([np.zeros(x.sum(), int), np.ones(y.sum(), int)])
    shingle = np.concatenate([np.repeat(keys, x), np.repeat(keys, y)])
    best = neardup.signatures(text, shingle, 2, slots=6000)
    want = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert abs((best[0] == best[1]).mean() - want) < 4 * (want * (1 - want) / 6000) ** 0.5
    # Least of exponential times: the mean of a slot is one over the weight.
    assert abs(best[0].mean() * x.sum() - 1) < 0.08


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5)]
    links += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(90)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = sorted((x, find(x)) for x in parent if find(x) != x)
    shuffled = [rng.choice([(a, b), (b, a)]) for a, b in links * 2]
    got = components(spark.createDataFrame(shuffled, "a long, b long"))
    assert sorted((r.a, r.b) for r in got.collect()) == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_agreeing_slots_estimate_similarity_and_rule_out_few():
    assert 145 <= neardup.fewest_agreeing(0.8) <= 155
    rng = np.random.default_rng(5)
    ruled_out = 0
    for _ in range(300):
        # 0.8: of 900 shingles in all 720 are in both.
        both = rng.integers(0, 1 << 62, 720, dtype=np.int64).astype(np.uint64)
        own = [rng.integers(0, 1 << 62, 90, dtype=np.int64).astype(np.uint64) for _ in range(2)]
        text = np.repeat([0, 1], 810)
        best = neardup.signatures(text, np.concatenate([both, own[0], both, own[1]]), 2)
        marks = neardup.slot_marks(best)
        ruled_out += int((marks[0] == marks[1]).sum()) < neardup.fewest_agreeing(0.8)
    assert ruled_out == 0


@pytest.mark.parametrize("n", [100, 200])
def test_texts_that_share_paragraphs_leave_few_pairs(spark, folder, monkeypatch, n):
    """12 of 20 shared paragraphs: all texts are alike to about 0.4, hardly any reach 0.8."""
    rng = random.Random(9)
    paragraphs = [" ".join(f"p{k}w{rng.randrange(300)}" for _ in range(60)) for k in range(20)]
    texts = [" ".join(paragraphs[k] for k in rng.sample(range(20), 12)) for _ in range(n)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).write.parquet(folder + "/d")
    compared = []
    real = neardup._verified

    def counted(pairs, held, least):
        compared.append(pairs.count())
        return real(pairs, held, least)

    monkeypatch.setattr(neardup, "_verified", counted)
    got = neardup.near_duplicates(spark.read.parquet(folder + "/d")).collect()
    want = brute(texts)
    assert sorted((r.doc_id, r.class_id) for r in got) == list(enumerate(want))
    assert sum(compared) <= 3 * n  # of n * (n - 1) / 2
