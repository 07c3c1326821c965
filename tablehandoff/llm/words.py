"""Words of whole texts as arrays: places, 64-bit hashes and hashes of word windows.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and
carriage return; UTF-8 has those bytes in no other character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

# Texts are handled together up to so many bytes; a longer text is handled alone.
SLICE_BYTES = 1 << 18

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n (base is odd)."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES // 4)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        have = (both[0], both[1])
        if n <= SLICE_BYTES + 1:  # those of one long text are not kept
            _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefix:
    """Polynomial prefix sums of a sequence of numbers: the hash of any part in one step."""

    def __init__(self, values: np.ndarray, base: int):
        up, self.down = powers(base, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def part(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        lengths = (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + lengths)

    def windows(self, width: int) -> np.ndarray:
        """The hash of every ``width`` consecutive values."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        length = np.uint64((width * 0xA24BAED4963EE407) % (1 << 64))
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n] + length)


class Words:
    """The words of some texts: ``starts``/``ends`` in ``data``, ``hashes``, and ``first``,
    the number of words before each text (one more entry than texts)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        """Text i is data[offsets[i]:offsets[i + 1]]."""
        self.data, self.offsets = data, offsets
        solid = ~SPACE[data]
        before = np.empty(len(data) + 1, dtype=bool)
        before[0] = False
        before[1:] = solid
        before[offsets] = False  # a text does not continue the one before
        self.starts = np.flatnonzero(solid & ~before[:-1])
        after = np.empty(len(data) + 1, dtype=bool)
        after[:-1] = solid
        after[-1] = False
        after[offsets] = False
        self.ends = np.flatnonzero(solid & ~after[1:]) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = Prefix(data.astype(np.uint64) + np.uint64(1), BYTE_BASE).part(
            self.starts, self.ends
        )

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the offsets of its texts; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first, last + 1, words) of runs of texts with about ``size`` bytes."""
    data, offsets = buffers(texts)
    low = 0
    while low < len(offsets) - 1:
        high = int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1
        high = min(max(high, low + 1), len(offsets) - 1)
        yield low, high, Words(
            data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        )
        low = high
