"""Passages of a benchmark in documents: fingerprints of item-sized windows.

A window has as many words as an item. Windows and items get a 64-bit SimHash of their word
shingles, weighted by how often they occur. A multi-index of eight 8-bit blocks finds the
items within RADIUS bits of a window: of two fingerprints at most RADIUS bits apart, one
block differs in at most RADIUS // 8 bits, and every block value within that distance is in
the index. Candidates are verified by the exact weighted Jaccard similarity of the shingles.

Only windows that can reach the similarity are fingerprinted: they need a known number of
shingles that are in the benchmark at all, which one running count over a text tells.

The benchmark is read in blocks of bounded size, each against all documents; there is no
shuffle of texts. At the default similarity the expected distance is about 10 bits with a
deviation of 3, so RADIUS is some five deviations away.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehandoff.llm.frames import col
from tablehandoff.llm.words import WORD_BASE, Prefix, Words, buffers, mix, slices

SHINGLE = 5
BLOCKS = 8
RADIUS = 24
# Characters of benchmark text that one pass over the documents searches for.
BLOCK_CHARS = 16_000_000

_BITS = np.arange(64, dtype=np.uint64)
_NEAR = np.array([v for v in range(256) if v.bit_count() <= RADIUS // BLOCKS], dtype=np.int64)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words; all words as one shingle if there are fewer."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    return Prefix(hashes, WORD_BASE).windows(min(size, len(hashes)))


def signs(hashes: np.ndarray) -> np.ndarray:
    """The bits of each hash as -1 and 1."""
    bits = (mix(hashes ^ np.uint64(0x5851F42D4C957F2D))[:, None] >> _BITS) & np.uint64(1)
    return bits.astype(np.int32) * 2 - 1


def pack(sums: np.ndarray) -> np.ndarray:
    """The fingerprint of each row of summed signs."""
    return ((sums > 0).astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two bags of shingles."""
    if not len(a) or not len(b):
        return 0.0
    keys, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    x = np.bincount(both[: len(a)], minlength=len(keys))
    y = np.bincount(both[len(a) :], minlength=len(keys))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


class Index:
    """The items of one block of the benchmark."""

    def __init__(self, items: list[tuple[int, str]], shingle: int, least: float):
        self.shingle, self.least = shingle, least
        words = Words(*buffers(pa.array([t for _, t in items], pa.string())))
        self.ids, self.bags, sizes = [], [], []
        for i, (item, _) in enumerate(items):
            hashes = words.hashes[words.first[i] : words.first[i + 1]]
            if len(hashes):  # an item without words is nowhere
                self.ids.append(item)
                self.bags.append(shingles(hashes, shingle))
                sizes.append(len(hashes))
        self.size_of = np.array(sizes, dtype=np.int64)
        self.sizes = np.unique(self.size_of)
        self.prints = np.array([int(pack(signs(b).sum(axis=0)[None])[0]) for b in self.bags], dtype=np.uint64)
        self.known = np.unique(np.concatenate([*self.bags, np.zeros(0, np.uint64)]))
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(self.known >> np.uint64(44)).astype(np.int64)] = True
        # Postings: the items of a size by block and by any block value near theirs.
        place = np.searchsorted(self.sizes, self.size_of)
        keys, owners = [], []
        for j in range(BLOCKS):
            value = ((self.prints >> np.uint64(8 * j)) & np.uint64(255)).astype(np.int64)
            near = value[:, None] ^ _NEAR
            keys.append(((place * BLOCKS + j)[:, None] * 256 + near).ravel())
            owners.append(np.repeat(np.arange(len(place)), len(_NEAR)))
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], owners[order]

    def need(self, size: int, n: np.ndarray | int) -> np.ndarray:
        """Shared shingles without which ``n`` shingles, or as many as the item has if those are
        fewer, and an item of ``size`` words stay below ``least``."""
        whole = max(size - self.shingle + 1, 1)
        both = np.clip(n, 0, whole) + whole
        return np.maximum(1, np.ceil(self.least * both / (1 + self.least) - 1e-9).astype(np.int64))

    def hits(self, found: np.ndarray) -> np.ndarray:
        """Which shingles are in the benchmark."""
        maybe = np.flatnonzero(self.seen[(found >> np.uint64(44)).astype(np.int64)])
        out = np.zeros(len(found), dtype=bool)
        place = np.searchsorted(self.known, found[maybe])
        place[place == len(self.known)] = 0
        out[maybe] = self.known[place] == found[maybe]
        return out

    def matches(self, hashes: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(item, first word, words, similarity) of the best window for each item in a text."""
        best: dict[int, tuple[float, int, int]] = {}
        sums_of: dict[int, np.ndarray] = {}
        for p, size in enumerate(self.sizes):
            size = int(min(size, len(hashes)))  # a shorter text is one window
            step = min(self.shingle, int(self.sizes[p]))
            if size < step:
                continue
            found = shingles(hashes, step)
            n = size - step + 1
            counts = np.concatenate([[0], np.cumsum(self.hits(found))])
            start = np.flatnonzero(counts[n:] - counts[:-n] >= self.need(int(self.sizes[p]), n))
            if not len(start):
                continue
            if step not in sums_of:
                sums_of[step] = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(signs(found), axis=0, dtype=np.int64)])
            prints = pack(sums_of[step][start + n] - sums_of[step][start])
            pairs = []
            for j in range(BLOCKS):
                key = (p * BLOCKS + j) * 256 + ((prints >> np.uint64(8 * j)) & np.uint64(255)).astype(np.int64)
                low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
                each = np.repeat(np.arange(len(start)), high - low)
                at = np.arange(len(each)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
                pairs.append(each * len(self.ids) + self.owners[low[each] + at])
            pairs = np.unique(np.concatenate(pairs))
            window, item = pairs // len(self.ids), pairs % len(self.ids)
            near = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
            for w, i in zip(window[near].tolist(), item[near].tolist()):
                s = int(start[w])
                score = similarity(found[s : s + n], self.bags[i])
                if score >= self.least and score > best.get(i, (0.0,))[0]:
                    best[i] = (score, s, size)
        return [(self.ids[i], s, n, score) for i, (score, s, n) in sorted(best.items())]


def match_rows(index: Index):
    # Of all items the smallest needs least, whatever the size of a text.
    smallest = int(index.sizes[0]) if len(index.sizes) else 0
    short = bool(len(index.sizes)) and int(index.sizes[0]) < index.shingle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for low, _, words in slices(batch.column(1)):
                found = Prefix(words.hashes, WORD_BASE).windows(index.shingle)
                counts = np.concatenate([[0], np.cumsum(index.hits(found))])
                first = np.minimum(words.first, len(found))
                # Shingles over the end of a text only make more of them worth a look.
                enough = counts[first[1:]] - counts[first[:-1]] >= index.need(smallest, words.counts - index.shingle + 1)
                if short:
                    enough[:] = True
                out = []
                for i in np.flatnonzero(enough | ((words.counts < index.shingle) & short)).tolist():
                    own = words.hashes[words.first[i] : words.first[i + 1]]
                    out += [(low + i, *m) for m in index.matches(own)]
                if out:
                    text, item, start, size, score = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(text)), pa.array(item, pa.int64()), pa.array(start, pa.int64()),
                         pa.array(size, pa.int64()), pa.array(score, pa.float64())],
                        ["key", "item_id", "start_word", "n_words", "similarity"],
                    )

    return run


def benchmark_blocks(items: DataFrame, id: str, text: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_chars`` characters, dealt by hash of id and text."""
    slim = items.select(col(id).cast("long").alias("id"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
    chars = slim.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    for b in range(blocks):
        of_block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b
        yield [(r.id, r.text) for r in slim.where(of_block).distinct().collect()]


def contaminated(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", least: float = 0.8, shingle: int = SHINGLE, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id``, ``item_id``, ``start_word``, ``n_words`` and ``similarity``: the best window of
    each document for each item it reaches ``least`` with; the first of equally good ones.

    A text with fewer words than an item is one window; an item with fewer words than a shingle
    is one shingle. Null and empty texts and items match nothing. Equal rows of ``docs`` give
    equal rows, equal items count once. Other columns are not read. Without documents or items
    the result is empty.
    """
    source = docs.select(col(doc_id).alias("key"), col(text).cast("string").alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    schema = f"key {kind}, item_id long, start_word long, n_words long, similarity double"
    found = [
        source.mapInArrow(match_rows(Index(block, shingle, least)), schema)
        for block in benchmark_blocks(items, item_id, item_text, block_chars)
    ]
    return reduce(DataFrame.unionByName, found).withColumnRenamed("key", "doc_id")
