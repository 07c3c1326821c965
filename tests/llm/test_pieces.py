"""Samples against enumerated segmentations; round trips."""

import math
from collections import Counter

import numpy as np
import pytest

from tablehandoff.llm import pieces

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
TINY = pieces.Vocabulary((None, "▁", "a", "b", "ab", "▁a", "ba", "aba", *[None] * 256), (9, 0, 1, 2, 3, 4, 5, 6, *[9] * 256), 8)


def enumerate_all(vocabulary, text):
    marked, weights = "▁" + text.replace(" ", "▁"), {}
    ids = {p: i for i, p in enumerate(vocabulary.pieces) if p}

    def walk(at, path, log):
        if at == len(marked):
            weights[tuple(path)] = log
            return
        for n in range(1, len(marked) - at + 1):
            i = ids.get(marked[at : at + n])
            if i is not None:
                walk(at + n, [*path, i], log - pieces.ALPHA * math.log1p(vocabulary.ranks[i]))

    walk(0, [], 0.0)
    total = math.log(sum(math.exp(v) for v in weights.values()))
    return {p: v - total for p, v in weights.items()}


@pytest.mark.parametrize("text", ["ab", "aba ab", "a  ba"])
def test_chances_of_ordered_samples(text):
    want = enumerate_all(TINY, text)
    trie, n, k = pieces.Trie(TINY), 6000, 3
    pairs, once = Counter(), Counter()
    estimate = 0.0
    for at in range(0, n, 500):
        by_text = {}
        for i, rank, log, _, inclusion, ids in pieces.sample_texts(trie, [text] * 500, list(range(at, at + 500)), k):
            path = tuple(ids.tolist())
            assert abs(want[path] - log) < 1e-9
            by_text.setdefault(i, []).append(path)
            estimate += math.exp(log - inclusion) * len(ids)
        for found in by_text.values():
            assert len(set(found)) == len(found) == min(k, len(want))
            once[found[0]] += 1
            if len(found) > 1:
                pairs[found[0], found[1]] += 1
    for x, lx in want.items():
        p = math.exp(lx)
        assert abs(once[x] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3
        for y, ly in want.items():
            if x != y:  # without replacement
                q = p * math.exp(ly) / (1 - p)
                assert abs(pairs[x, y] / n - q) < 5 * math.sqrt(q * (1 - q) / n) + 1e-3
    mean = sum(math.exp(v) * len(p) for p, v in want.items())
    assert abs(estimate / n - mean) < 0.15 * mean


def test_rows_and_round_trip(spark):
    vocabulary = pieces.load(MODEL)
    texts = [
        "Hello  world\n a", " lead and trail ", "", None, "a\tb　c ﬁ 𝄞 \U0001f600\x00", "x", "\n\n", "é" * 300,
        "word " * 20_000, "nospace" * 3000, "Licensed under CC BY-NC 4.0.",
    ]
    rows = [(i, t, "r", 1) for i, t in enumerate(texts)] + [(0, texts[0], "r", 1), (None, "null key", "r", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rank string, ids int").repartition(2)
    made = pieces.sample_segmentations(df, vocabulary, k=3).persist()
    assert made.columns == ["doc_id", *pieces.RESULTS]
    by = {}
    for r in made.collect():
        assert r.n_pieces == len(r.ids) and r.log_inclusion <= 0 and r.round_trip
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[3]) == len(by[2]) == 1 and by[2][0].ids == [] and by[2][0].log_inclusion == 0
    assert len(by[8]) == 3 and len(by[0]) == 6 and len({tuple(r.ids) for r in by[0]}) == 3
    for found in by.values():
        assert [r.perturbed for r in sorted(found, key=lambda r: r.rank)] == sorted((r.perturbed for r in found), reverse=True)
    decoded = pieces.decode(made.select("doc_id", "rank", "ids"), vocabulary).collect()
    want = {i: (t or "").replace("▁", " ") for i, t in enumerate(texts)} | {None: "null key"}
    assert all(r.decoded == want[r.doc_id] for r in decoded) and len(decoded) == made.count()
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in by[0] + by[10]:
        assert model.decode(list(r.ids)) == texts[r.doc_id]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.sample_segmentations(df, TINY).count() == 0


def test_all_segmentations_have_inclusion_one():
    found = list(pieces.sample_texts(pieces.Trie(TINY), ["a"], [3], 10))
    assert len(found) == 2 and all(x[4] == 0 for x in found)
    assert np.isclose(sum(math.exp(x[2]) for x in found), 1)


def test_kept_lattices_change_nothing(monkeypatch):
    texts = ["aba ab", "a  ba", "ab", "aba ab aba", "", "ba\nab", "abab" * 9]

    def samples(trie, order):
        found = {}
        for i in order:
            found[i] = [(r, round(p, 12), ids.tolist()) for _, r, p, _, _, ids in pieces.sample_texts(trie, [texts[i]], [i], 3)]
        return found

    fresh = {}
    for i in range(len(texts)):
        fresh |= samples(pieces.Trie(TINY), [i])
    assert samples(pieces.Trie(TINY), range(len(texts))) == fresh
    assert samples(pieces.Trie(TINY), reversed(range(len(texts)))) == fresh
    monkeypatch.setattr(pieces, "KEPT_PLACES", 4)
    assert samples(pieces.Trie(TINY), [3, 1, 3, 0, 2, 4, 6, 5]) == fresh
