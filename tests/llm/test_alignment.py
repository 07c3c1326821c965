"""Ids of whole texts against the libraries; groups, links and counts against a plain walk."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tablehandoff.llm import alignment, tokens
from tablehandoff.llm.queries import BYTES, PIECES

SCHEMA = "doc_id long, text string, slice string, n_a int, `odd ``name` int"
MIXED = "aB1 '.,s\n\t   　\u0085é漢▁ \x1c\x00ß😀\r\x0b'tll-"


def mixed_texts(n, seed=1):
    draw = random.Random(seed)
    made = ["".join(draw.choice(MIXED) for _ in range(draw.randint(0, 40))) for _ in range(n)]
    return made + ["x<|endoftext|> y", " <|endoftext|>\nb <s> </s> <0x41>", "a   b é à\nÀ", None, "", " ", "\n"]


def test_ids_by_chunks_are_those_of_whole_texts():
    texts = mixed_texts(4000)
    plain, special = Tokenizer.from_file(BYTES), Tokenizer.from_file(BYTES)
    plain.encode_special_tokens = True
    model = tokens._piece_model(PIECES)
    for _, _, data, offsets in tokens.text_slices(pa.array(texts), 1 << 14):
        at = [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])]
        blank, moved = tokens.with_blank(data, offsets)
        for encoder, where, want in (
            (tokens.byte_encoder(BYTES, True), (blank, moved), lambda t: plain.encode(" " + t, add_special_tokens=False).ids),
            (tokens.byte_encoder(BYTES), (data, offsets), lambda t: special.encode(t, add_special_tokens=False).ids),
            (tokens.piece_encoder(PIECES), (blank, moved), lambda t: model.encode(t)),
        ):
            ids, first, _ = encoder(*where)
            for i, text in enumerate(at):
                assert ids[first[i] : first[i + 1]].tolist() == want(text), repr(text)


def test_colliding_hashes_and_a_full_cache_change_nothing(monkeypatch):
    texts = mixed_texts(300, 5)
    slices = list(tokens.text_slices(pa.array(texts), 1 << 10))
    want = [tokens.Encoder(tokens.byte_encoder(BYTES).encode, tokens.byte_strings(BYTES))(d, o)[0].tolist() for _, _, d, o in slices]
    monkeypatch.setattr(tokens, "KEPT_CHUNKS", 5)
    small = tokens.Encoder(tokens.byte_encoder(BYTES).encode, tokens.byte_strings(BYTES))
    assert [small(d, o)[0].tolist() for _, _, d, o in slices] == want

    class Forged:  # only the length of a chunk tells it from others
        def __init__(self, values, base):
            pass

        def part(self, start, end):
            return (end - start).astype(np.uint64)

    monkeypatch.setattr(tokens, "Prefix", Forged)
    forged = tokens.Encoder(tokens.byte_encoder(BYTES).encode, tokens.byte_strings(BYTES))
    assert [forged(d, o)[0].tolist() for _, _, d, o in slices] == want


def walk(a, b):
    """Groups of two end lists, one token at a time."""
    groups, i, j = [], 0, 0
    while i < len(a):
        x, y = i, j
        while a[i] != b[j]:
            if a[i] < b[j]:
                i += 1
            else:
                j += 1
        i, j = i + 1, j + 1
        groups.append((x, i, y, j))
    return groups


@pytest.mark.parametrize("seed", range(6))
def test_groups(seed):
    draw = random.Random(seed)
    for _ in range(200):
        n = draw.randint(1, 60)
        common = {n}
        a = sorted({x for x in range(1, n) if draw.random() < draw.choice([0.1, 0.5, 0.97])} | common)
        b = sorted({x for x in range(1, n) if draw.random() < draw.choice([0.1, 0.5, 0.97])} | common)
        want = walk(a, b)
        found = [tuple(g) for g in alignment.irregular_groups(np.array(a), np.array(b)).tolist()]
        assert found == [g for g in want if g[1] - g[0] > 1 or g[3] - g[2] > 1]
        starts = alignment.group_starts(np.array(a), np.array(b))
        assert starts[0].tolist() == [g[0] for g in want] and starts[1].tolist() == [g[2] for g in want]


def brute(rows):
    plain = Tokenizer.from_file(BYTES)
    plain.encode_special_tokens = True
    model, of_a, of_b = tokens._piece_model(PIECES), tokens.byte_strings(BYTES), tokens.piece_strings(PIECES)
    links, notation, sizes = [], [], []
    for text in rows:
        whole = (" " + (text or "")).encode()
        a, b = plain.encode(whole.decode(), add_special_tokens=False).ids, model.encode(text or "")
        if not text or b"".join(of_a[x] for x in a) != whole or b"".join(of_b[x] for x in b) != whole:
            links.append([]), notation.append(""), sizes.append((0, 0, 0))
            continue
        groups = walk(np.cumsum([len(of_a[x]) for x in a]).tolist(), np.cumsum([len(of_b[x]) for x in b]).tolist())
        links.append([(x, y) for i, k, j, m in groups for x in a[i:k] for y in b[j:m]])
        notation.append(";".join(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])) for i, k, j, m in groups))
        sizes.append((len(a), len(b), len(groups)))
    count, highest = defaultdict(int), defaultdict(int)
    for found in links:
        for pair in set(found):
            count[pair] += 1
    for (x, _), c in count.items():
        highest[x] = max(highest[x], c)
    return [
        (*size, len(found), sum(count[p] == highest[p[0]] for p in found), sum(count[p] for p in found),
         hashlib.sha256(text.encode()).hexdigest() if text else "")
        for size, found, text in zip(sizes, links, notation)
    ]


@pytest.mark.parametrize("size,flat", [(1 << 22, 1 << 10), (64, 2)])
def test_links_and_counts(spark, folder, monkeypatch, size, flat):
    monkeypatch.setattr(alignment, "SLICE_BYTES", size)
    monkeypatch.setattr(alignment, "FLAT_PAIRS", flat)
    texts = mixed_texts(150, 3) + ["the same text again"] * 30 + ["Donaudampfschifffahrt und aaaaaaaaaaaaaaaaaaaaaaaa " * 60, "漢字" * 200]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    got = alignment.align(df, BYTES, PIECES)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(i, *rest) for (i, _), rest in zip(rows, brute(texts))]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_long_text_and_no_rows(spark):
    long = "One very long text, with Wörter and numbers 12345. " * 60_000  # 3 MB
    df = spark.createDataFrame([("k", long), ("e", "")], "doc_id string, text string")
    got = {r.doc_id: r for r in alignment.align(df, BYTES, PIECES).collect()}
    assert got["k"].n_links >= got["k"].n_groups > 600_000 and got["k"].n_best <= got["k"].n_links
    assert got["e"][1:] == (0, 0, 0, 0, 0, 0, "")
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), BYTES, PIECES).count() == 0
