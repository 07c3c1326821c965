"""Benchmark passages against a comparison of every window with every item."""

import random
from collections import Counter

import pytest

from tablehandoff.llm.decontaminate import contaminated

DOCS = "doc_id long, text string, item_id string, similarity string"


def bag(words, size=5):
    size = min(size, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else Counter()


def brute(docs, items, least=0.8):
    out = {}
    for d, t in docs:
        w = (t or "").split()
        for i, x in items:
            v = (x or "").split()
            if not v or not w:
                continue
            n, size = min(len(v), len(w)), min(5, len(v))
            if len(w) < size:
                continue
            want = bag(v)
            for s in range(len(w) - n + 1):
                own = bag(w[s : s + n], size)
                both = sum((own & want).values()) / sum((own | want).values())
                if both >= least and both > out.get((d, i), (0,))[0]:
                    out[d, i] = (both, s, n)
    return sorted((d, i, s, n, round(x, 9)) for (d, i), (x, s, n) in out.items())


def run(spark, docs, items, folder, **more):
    spark.createDataFrame([(d, t, "a", "b") for d, t in docs], DOCS).write.mode("overwrite").parquet(folder + "/d")
    spark.createDataFrame(items, "item_id long, text string").write.mode("overwrite").parquet(folder + "/i")
    got = contaminated(spark.read.parquet(folder + "/d"), spark.read.parquet(folder + "/i"), **more)
    assert got.columns == ["doc_id", "item_id", "start_word", "n_words", "similarity"]
    return sorted((r.doc_id, r.item_id, r.start_word, r.n_words, round(r.similarity, 9)) for r in got.collect())


def cases():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(words(n))) for i, n in enumerate([15, 16, 25, 40, 59, 5, 4, 1, 30])]
    items += [(20, None), (21, ""), (22, "a b a b a b a b a b a b a b a b"), (23, "b " * 30), (23, "b " * 30)]
    docs = [(100, None), (101, ""), (102, "w1"), (103, "a b " * 40), (104, "b " * 25)]
    for n in range(120):
        _, t = rng.choice(items[:9])
        part = t.split() + ["end"]
        for _ in range(min(rng.choice([0, 0, 1, 2, 3]), len(part) - 1)):
            at = rng.randrange(len(part))
            part = part[:at] + rng.choice([[], ["new"], [part[at], "new"]]) + part[at + 1 :]
        docs.append((n, " ".join(words(rng.choice([0, 3, 80])) + part + words(rng.choice([0, 2, 90])))))
    return docs + docs[5:8], items


def test_against_all_windows(spark, folder):
    docs, items = cases()
    got = run(spark, docs, items, folder)
    want = brute(docs[:-3], sorted(set(items), key=str))
    assert sorted(set(got)) == want
    assert len(got) >= len(want) > 40


@pytest.mark.parametrize("size", [59, 100])
def test_texts_shorter_than_items(spark, folder, size):
    rng = random.Random(size)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    items = [(i, " ".join(words(size))) for i in range(12)]
    docs = []
    for n in range(150):
        t = rng.choice(items)[1].split()
        cut = rng.randrange(size // 4)
        part = t[cut // 2 : size - cut + cut // 2]
        for _ in range(n % 3):
            part[rng.choice([0, 1, 2, -1, -2, -3, len(part) // 2])] = "new"
        docs.append((n, " ".join(part)))
    item = items[0][1].split()
    docs += [(500, " ".join(["new", "new", *item[2 : size - 6]])), (501, " ".join(item[: size - size // 8])), (502, "w1 w2"), (503, " ".join(item))]
    got, want = run(spark, docs, items, folder), brute(docs, items)
    assert got == want and len({d for d, *_, n, _ in want if n < size}) > 60


def test_blocks_give_the_same(spark, folder):
    docs, items = cases()
    assert run(spark, docs, items, folder) == run(spark, docs, items, folder, block_chars=200)


@pytest.mark.parametrize("docs, items", [([], [(1, "a b c d e f")]), ([(1, "a b c d e f")], [])])
def test_empty_tables(spark, folder, docs, items):
    assert run(spark, docs, items, folder) == []
