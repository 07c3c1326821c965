"""Token ids of whole texts, encoded once for each distinct chunk.

A chunk ends before a blank or line feed that stands between two characters other than white
space. Byte-level BPE with the usual pattern starts a word there, and a piece model none of
whose pieces goes on behind a character with a blank or holds a line feed ends a piece there;
so the ids of a text are those of its chunks in order, and a worker encodes a chunk it has met
before by looking it up. What a worker keeps is bounded; beyond that it starts anew.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa

from tablehandoff.llm.words import BYTE_BASE, Prefix, buffers

# Chunks and ids a worker keeps.
KEPT_CHUNKS = 600_000
KEPT_IDS = 4_000_000
BLANK = "▁"

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
# First bytes of characters beyond ASCII of which some are white space.
_MAYBE_WHITE = np.zeros(256, dtype=bool)
_MAYBE_WHITE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def with_blank(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same texts, each with a blank in front."""
    n = len(offsets) - 1
    out = np.full(len(data) + n, 32, dtype=np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = data
    return out, offsets + np.arange(n + 1)


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin in texts that lie one behind the other."""
    begins = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 2:
        before, here, behind = data[:-2], data[1:-1], data[2:]
        gap = ((here == 32) | (here == 10)) & ~_WHITE[before] & ~_WHITE[behind]
        begins[1:-2] = gap & (~_MAYBE_WHITE[behind] | (before < 0x80))
        begins[offsets[1:] - 1] = False  # the last byte of a text has no character behind it
    begins[offsets] = True
    return np.flatnonzero(begins[:-1])


class Encoder:
    """Ids of texts by a function from a string to ids, with the chunks it has met."""

    def __init__(self, encode: Callable[[bytes], Sequence[int]], spelled: Sequence[bytes]):
        """``spelled``: the bytes of each id."""
        self.encode = encode
        self.lengths = np.array([len(x) for x in spelled], dtype=np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.clear()

    def clear(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _encoded(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each chunk)."""
        parts = [self.encode(c) for c in chunks]
        counts = np.array([len(p) for p in parts], dtype=np.int64)
        return np.concatenate([np.zeros(0, np.int32), *[np.array(p, dtype=np.int32) for p in parts]]), counts

    def _joined(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for chunks that stay chunks when one follows the other: one string, cut again
        where the ids spell the end of a chunk."""
        sizes = ends - starts
        stops = np.cumsum(sizes)
        total = int(stops[-1]) if len(stops) else 0
        text = data[np.repeat(starts - (stops - sizes), sizes) + np.arange(total)]
        ids = np.array(self.encode(text.tobytes()) if total else [], dtype=np.int32)
        spelled = np.cumsum(self.lengths[ids])
        cut = np.searchsorted(spelled, stops)
        if not total or (len(spelled) and spelled[-1] == total and (spelled[cut] == stops).all()):
            return ids, np.diff(cut + 1, prepend=0)
        return self._encoded([data[a:b].tobytes() for a, b in zip(starts, ends)])

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        second = data[np.minimum(starts + 1, len(data) - 1)]
        gap = ((data[starts] == 32) | (data[starts] == 10)) & (ends - starts > 1)
        plain = gap & ~_WHITE[data[ends - 1]] & ~_WHITE[second] & ~_MAYBE_WHITE[second]
        made = [self._joined(data, starts[plain], ends[plain])]
        made.append(self._encoded([data[a:b].tobytes() for a, b in zip(starts[~plain], ends[~plain])]))
        counts = np.concatenate([m[1] for m in made])
        slots = len(self.counts) + np.argsort(np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)]))
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, *[m[0] for m in made]])
        order = np.argsort(every := np.concatenate([self.keys, keys]), kind="stable")
        self.keys, self.slots = every[order], np.concatenate([self.slots, slots])[order]

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, where those of each text begin, whether they spell the text)."""
        if len(self.keys) > KEPT_CHUNKS or len(self.ids) > KEPT_IDS:
            self.clear()
        starts = chunk_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes = Prefix(data.astype(np.uint64) + np.uint64(1), BYTE_BASE).part(starts, ends)
        keys, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), dtype=bool)
        if len(self.keys):
            new = self.keys[np.minimum(place, len(self.keys) - 1)] != keys
        if new.any():
            self._learn(keys[new], data, starts[sample[new]], ends[sample[new]])
            place = np.searchsorted(self.keys, keys)
        slots = self.slots[place][which]
        counts = self.counts[slots]
        stops = np.cumsum(counts)
        total = int(stops[-1]) if len(stops) else 0
        ids = self.ids[np.repeat(self.first[slots] - (stops - counts), counts) + np.arange(total)]
        first = np.concatenate([[0], stops])[np.searchsorted(starts, offsets)]
        exact = self._spells(ids, first, data, offsets)
        if exact.all():
            return ids, first, exact
        # Two chunks with one hash, or a text that the ids cannot spell: such texts as a whole.
        parts = [ids[a:b] for a, b in zip(first, first[1:])]
        for i in np.flatnonzero(~exact).tolist():
            parts[i] = np.array(self.encode(data[offsets[i] : offsets[i + 1]].tobytes()), dtype=np.int32)
        ids, first = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, first, self._spells(ids, first, data, offsets)

    def _spells(self, ids: np.ndarray, first: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        bounds = np.concatenate([[0], ends])[first]
        spelled = self.bytes[np.repeat(self.places[ids] - (ends - sizes), sizes) + np.arange(total)]
        if np.array_equal(bounds, offsets):
            wrong = np.concatenate([[0], np.cumsum(spelled != data)])
            return np.diff(wrong[offsets]) == 0
        return np.array([np.array_equal(spelled[a:b], data[c:d]) for a, b, c, d in zip(bounds, bounds[1:], offsets, offsets[1:])])


def _byte_of() -> dict[str, int]:
    """The byte that a character stands for in a byte-level vocabulary: printable ones for
    themselves, the others for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def _byte_model(file: str, plain_specials: bool):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(file)
    model.encode_special_tokens = plain_specials
    return model


@lru_cache(maxsize=2)
def byte_encoder(file: str, plain_specials: bool = False) -> Encoder:
    """A byte-level BPE vocabulary. ``plain_specials``: special tokens in a text are plain text."""
    model = _byte_model(file, plain_specials)

    def encode(text: bytes) -> list[int]:
        return model.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids

    return Encoder(encode, byte_strings(file))


@lru_cache(maxsize=2)
def byte_strings(file: str) -> tuple[bytes, ...]:
    """The bytes of each id of a byte-level vocabulary."""
    byte_of = _byte_of()
    model = _byte_model(file, True)
    pieces = [model.id_to_token(i) or "" for i in range(model.get_vocab_size(with_added_tokens=True))]
    return tuple(bytes(byte_of[c] for c in p) if all(c in byte_of for c in p) else p.encode() for p in pieces)


@lru_cache(maxsize=2)
def _piece_model(file: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=file)


@lru_cache(maxsize=2)
def piece_strings(file: str) -> tuple[bytes, ...]:
    """The bytes of each id of a piece model: U+2581 is a blank, <0xHH> one byte, control ids none."""
    model = _piece_model(file)
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            out.append(b"" if model.is_control(i) or model.is_unknown(i) else piece.replace(BLANK, " ").encode())
    return tuple(out)


@lru_cache(maxsize=2)
def piece_encoder(file: str) -> Encoder:
    """A piece model that puts a blank before a text, on texts that already have that blank.

    The model must end pieces where chunks end, see the module; others are an error.
    """
    model = _piece_model(file)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any(BLANK in p.lstrip(BLANK) or "\n" in p for p in pieces):
        raise ValueError(f"pieces of {file} go on behind a blank or line feed")

    def encode(text: bytes) -> list[int]:
        # The model adds the blank; before a line feed it is a piece of its own and goes again.
        blank = text[:1] == b" "
        ids = model.encode((text[1:] if blank else text).decode(), num_threads=1)
        return ids if blank else ids[1:]

    return Encoder(encode, piece_strings(file))


def text_slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last + 1, bytes, offsets) of runs of texts with about ``size`` bytes; a longer text
    is alone. A null text counts as empty."""
    data, offsets = buffers(texts)
    low = 0
    while low < len(offsets) - 1:
        high = int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1
        high = min(max(high, low + 1), len(offsets) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high
