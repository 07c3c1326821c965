"""Sampled piece segmentations without replacement, and their decoding.

A text is a lattice: its nodes are the places between characters, its edges the pieces of the
vocabulary (and the byte pieces of a character without a piece). A segmentation has the
product of the weights of its pieces, a piece of rank r the weight (1 + r)^-ALPHA.

Pieces do not cross the start of a word, so the lattice is a chain of word lattices. The
weights to the end of a word are summed backwards once for each distinct word, and a worker keeps
the lattices of words it has met, up to a bound; forward from there, pieces are drawn with exact chances.

The ``k`` segmentations of a text are those with the largest Gumbel-perturbed log weights,
found best first: the queue holds sets of segmentations that share words up to a place and
differ there from those already found, each with the largest perturbed value in it (a
Gumbel truncated by that of its parent set). The set with the largest value gives the next
segmentation and is split into the sets around it. All draws are hashes of the row's seed.

``log_inclusion`` is the log of the chance to be among the ``k`` given the perturbed value that
follows them, which makes weighted averages over the samples unbiased.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehandoff.llm.frames import numbered, unpacked
from tablehandoff.llm.words import Prefix, buffers, mix

ALPHA = 1.0
BLANK = 0x2581  # stands for a blank inside pieces
SLICE_BYTES = 1 << 19
SLOT_BITS = 20
# Places of words whose lattices a worker keeps; beyond that it starts anew.
KEPT_PLACES = 1 << 20
_CODE_BASE = 0xC2B2AE3D27D4EB4F
_STEP = 0x9E3779B97F4A7C15
# Chances below this are rounding errors.
NOTHING = 1e-12
RESULTS = ["rank", "n_pieces", "log_prob", "perturbed", "log_inclusion", "ids", "round_trip"]


class Vocabulary(NamedTuple):
    """Pieces by id; what is not an ordinary piece is null. ``first_byte``: id of byte 0."""

    pieces: tuple[str | None, ...]
    ranks: tuple[int, ...]
    first_byte: int


def load(model_file: str) -> Vocabulary:
    """Reads a model with byte pieces on the driver; tasks get the pieces, not the file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = model.get_piece_size()
    ordinary = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
    by_score = sorted((i for i in range(n) if ordinary[i]), key=lambda i: (-model.get_score(i), i))
    ranks = [n] * n
    for rank, i in enumerate(by_score):
        ranks[i] = rank
    pieces = tuple(model.id_to_piece(i) if ordinary[i] else None for i in range(n))
    return Vocabulary(pieces, tuple(ranks), model.piece_to_id("<0x00>"))


class Trie:
    """Pieces as paths of characters; transitions are one sorted array."""

    def __init__(self, vocabulary: Vocabulary):
        steps: dict[int, int] = {}
        ends: dict[int, int] = {}
        count = 1
        for i, piece in enumerate(vocabulary.pieces):
            if piece is None:
                continue
            node = 0
            for c in piece:
                key = node << 21 | ord(c)
                node = steps.get(key, 0)
                if not node:
                    node = steps[key] = count
                    count += 1
            ends.setdefault(node, i)
        keys = np.fromiter(steps.keys(), np.int64, len(steps))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.nodes = np.fromiter(steps.values(), np.int64, len(steps))[order]
        # Most transitions are found by one look into a table; where two keys share a slot,
        # by a search.
        slot = self._slot(self.keys)
        self.table = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
        self.table[slot] = np.arange(len(slot))
        self.table[np.flatnonzero(np.bincount(slot, minlength=1 << SLOT_BITS) > 1)] = -2
        self.piece = np.full(count, -1, np.int64)
        for node, i in ends.items():
            self.piece[node] = i
        self.weight = -ALPHA * np.log1p(np.array(vocabulary.ranks, dtype=np.float64))
        self.byte_weight = float(-ALPHA * np.log1p(len(vocabulary.pieces)))
        self.first_byte = vocabulary.first_byte
        raw = [(p or "").replace(chr(BLANK), " ").encode() for p in vocabulary.pieces]
        for b in range(256):
            raw[vocabulary.first_byte + b] = bytes([b])
        self.lengths = np.array([len(x) for x in raw], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.lattices: Lattices | None = None  # of the words met so far

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(_STEP)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def step(self, node: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the nodes have a transition, where those lead)."""
        key = node << 21 | code
        place = self.table[self._slot(key)]
        shared = np.flatnonzero(place == -2)
        if len(shared):
            place[shared] = np.minimum(np.searchsorted(self.keys, key[shared]), len(self.keys) - 1)
        found = np.flatnonzero((place >= 0) & (self.keys[place] == key))
        return found, self.nodes[place[found]]


@lru_cache(maxsize=2)
def trie_of(vocabulary: Vocabulary) -> Trie:
    return Trie(vocabulary)


_MASK = (1 << 64) - 1


def _mix_one(x: int) -> int:
    """``mix`` of one number."""
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & _MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & _MASK
    return x ^ (x >> 31)


def _uniform_one(x: int) -> float:
    return ((_mix_one(x & _MASK) >> 11) + 0.5) * 2.0**-53


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((mix(x) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Lattices:
    """The lattices of distinct words; word i has the places first[i] to end[i]."""

    def __init__(self, trie: Trie):
        self.trie = trie
        self.clear()

    def clear(self) -> None:
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first, self.end, self.edge = (np.zeros(0, np.int64) for _ in range(3))
        self.size, self.piece = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.log, self.upto = np.zeros(0), np.zeros(0)

    def words(self, keys: np.ndarray, codes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The numbers of the words start..stop of ``codes``; words not met before are added.

        ``keys`` are hashes of the words: equal ones are one word.
        """
        if len(self.edge) > KEPT_PLACES:
            self.clear()
        distinct, sample, which = np.unique(keys, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        new = np.ones(len(distinct), dtype=bool)
        if len(self.keys):
            new = self.keys[np.minimum(place, len(self.keys) - 1)] != distinct
        if new.any():
            lengths = (stop - start)[sample[new]]
            first = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            taken = np.repeat(start[sample[new]] - first[:-1], lengths) + np.arange(first[-1])
            every = np.concatenate([self.keys, distinct[new]])
            numbers = np.concatenate([self.numbers, len(self.first) + np.arange(len(lengths))])
            self._add(codes[taken], first)
            order = np.argsort(every, kind="stable")
            self.keys, self.numbers = every[order], numbers[order]
            place = np.searchsorted(self.keys, distinct)
        return self.numbers[place][which]

    def _add(self, codes: np.ndarray, first: np.ndarray) -> None:
        """The lattices of more words: ``codes`` of all of them, word i from first[i] to first[i + 1]."""
        trie, n = self.trie, len(codes)
        end = np.repeat(first[1:], np.diff(first))
        at = np.arange(n)
        starts, sizes, pieces = [], [], []
        active, node, depth = at, np.zeros(n, np.int64), 0
        while len(active):
            inside = active + depth < end[active]
            active, node = active[inside], node[inside]
            found, node = trie.step(node, codes[active + depth])
            active, depth = active[found], depth + 1
            piece = trie.piece[node]
            ends = piece >= 0
            starts.append(active[ends])
            sizes.append(np.full(int(ends.sum()), depth))
            pieces.append(piece[ends])
        single = np.zeros(n, dtype=bool)
        single[starts[0] if starts else []] = True
        bare = np.flatnonzero(~single)  # characters that only bytes can spell
        starts.append(bare)
        sizes.append(np.ones(len(bare), np.int64))
        pieces.append(-codes[bare] - 1)
        start, size, piece = np.concatenate(starts), np.concatenate(sizes), np.concatenate(pieces)
        left = end[start] - start
        order = np.argsort(left * (n + 1) + start)
        start, size, piece, left = start[order], size[order], piece[order], left[order]
        code = -piece - 1
        n_bytes = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        weight = np.where(piece >= 0, trie.weight[np.maximum(piece, 0)], n_bytes * trie.byte_weight)
        total = np.zeros(n + 1)
        value = np.empty(len(start))
        bounds = np.flatnonzero(np.diff(left, prepend=-1))
        for low, high in zip(bounds, np.append(bounds[1:], len(left))):
            rest = np.where(size[low:high] == left[low:high], 0.0, total[start[low:high] + size[low:high]])
            value[low:high] = weight[low:high] + rest
            own = np.flatnonzero(np.diff(start[low:high], prepend=-1))
            total[start[low:high][own]] = np.logaddexp.reduceat(value[low:high], own)
        log = value - total[start]
        chance = np.exp(log)
        order = np.argsort(start - 0.999 * chance)  # the likeliest edge of a place first
        size, piece, log, chance = size[order], piece[order], log[order], chance[order]
        sums = np.cumsum(chance)
        own = np.flatnonzero(np.diff(start[order], prepend=-1))
        before = np.repeat(sums[own] - chance[own], np.diff(np.append(own, len(sums))))
        # Chance up to and with each edge of its place; the last one takes what rounding leaves.
        upto = sums - before
        upto[np.append(own[1:], len(sums)) - 1 if len(own) else own] = 2.0
        places, edges = len(self.edge), len(self.size)
        self.first = np.concatenate([self.first, first[:-1] + places])
        self.end = np.concatenate([self.end, first[1:] + places])
        self.edge = np.concatenate([self.edge, own + edges])
        self.size, self.piece = np.concatenate([self.size, size]), np.concatenate([self.piece, piece])
        self.log, self.upto = np.concatenate([self.log, log]), np.concatenate([self.upto, upto])

    def draw(self, word: np.ndarray, seed: np.ndarray):
        """A segmentation of each word: (pieces before each word, pieces in order, log chances)."""
        n = len(word)
        place, stop = self.first[word], self.end[word]
        log = np.zeros(n)
        which, steps, pieces = [], [], []
        active, step = np.arange(n), 0
        while len(active):
            u = _uniform(seed[active] + np.uint64(((step + 1) * _STEP) % (1 << 64)))
            edge = self.edge[place[active]]
            later = np.flatnonzero(u >= self.upto[edge])
            while len(later):
                edge[later] += 1
                later = later[u[later] >= self.upto[edge[later]]]
            log[active] += self.log[edge]
            which.append(active)
            steps.append(np.full(len(active), step))
            pieces.append(self.piece[edge])
            place[active] += self.size[edge]
            active, step = active[place[active] < stop[active]], step + 1
        if not which:
            return np.zeros(1, np.int64), np.zeros(0, np.int64), log
        which, steps, pieces = np.concatenate(which), np.concatenate(steps), np.concatenate(pieces)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=n))])
        out = np.empty(len(pieces), np.int64)
        out[offsets[which] + steps] = pieces
        return offsets, out, log


    def draw_other(self, word: int, seed: int, without: tuple[tuple[int, ...], ...]) -> tuple[np.ndarray, float]:
        """(pieces, log chance) of a segmentation of one word, drawn from all but ``without``."""
        place, stop, log, step, out = int(self.first[word]), int(self.end[word]), 0.0, 0, []
        while place < stop:
            low = int(self.edge[place])
            high = int(self.edge[place + 1]) if place + 1 < len(self.edge) else len(self.piece)
            pieces, logs = self.piece[low:high].tolist(), self.log[low:high].tolist()
            open_mass = [math.exp(x) for x in logs]
            for w in without:
                at = pieces.index(w[step])
                open_mass[at] -= self._rest(place, w, step)
            open_mass = [max(x, 0.0) for x in open_mass]
            left = _uniform_one(seed + (step + 1) * _STEP) * sum(open_mass)
            chosen = 0
            for i, mass in enumerate(open_mass):
                if mass > 0.0:  # the last one with any takes what rounding leaves
                    chosen = i
                    if left < mass:
                        break
                    left -= mass
            log += logs[chosen]
            out.append(pieces[chosen])
            without = tuple(w for w in without if w[step] == pieces[chosen])
            place, step = place + int(self.size[low + chosen]), step + 1
        return np.array(out, dtype=np.int64), log

    def _rest(self, place: int, pieces: tuple[int, ...], step: int) -> float:
        """The chance to go on from ``place`` with the pieces from ``step``."""
        log = 0.0
        for piece in pieces[step:]:
            edge = int(self.edge[place])
            while self.piece[edge] != piece:
                edge += 1
            log += float(self.log[edge])
            place += int(self.size[edge])
        return math.exp(log)


class _Path(NamedTuple):
    """A segmentation of a text: words before ``at`` are the parent's, word ``at`` its own, the
    others those of draw ``number``."""

    number: int
    at: int
    parent: _Path | None
    own: np.ndarray | None  # pieces of word ``at``
    logs: np.ndarray


def _gumbel(u):
    return -np.log(-np.log(u))


def _truncated(location, u, bound):
    """Gumbel draws at ``location`` that are at most ``bound``."""
    free = location + _gumbel(u)
    # v = -log(exp(-bound) - exp(-max) + exp(-free)) with the maximum at infinity
    return -np.logaddexp(-bound, -free)


def _search(draws, lattices: Lattices, words: np.ndarray, low: int, high: int, seed: int, k: int):
    """The ``k`` best perturbed segmentations of the words low..high: (path, log, perturbed), and
    the perturbed value that follows."""
    n = high - low
    top = -math.log(-math.log(_uniform_one(seed)))
    queue: list = [(-top, 0, -1, None, (), 0.0)]
    found, made = [], 0
    while queue and len(found) < k:
        minus, _, at, parent, without, gone = heapq.heappop(queue)
        value, number = -minus, len(found)
        offsets, pieces, log = draws[number]
        if parent is None:
            path, begin = _Path(number, 0, None, None, log[low:high]), 0
        else:
            own, one = lattices.draw_other(int(words[low + at]), (seed + number * 7907 + at) & _MASK, without)
            path = _Path(number, at, parent, own, np.concatenate([parent.logs[:at], [one], log[low + at + 1 : high]]))
            begin = at
        found.append((path, float(path.logs.sum()), value))
        if not n:
            continue
        before = np.concatenate([[0.0], np.cumsum(path.logs)[:-1]])[begin:]
        rest = -np.expm1(path.logs[begin:])
        if parent is not None:  # the set split here had lost some segmentations of the word already
            rest[0] = rest[0] - gone
        open_at = np.flatnonzero(rest > NOTHING)
        if not len(open_at):
            continue
        u = _uniform(np.uint64((seed + (number + 1) * 7919) % (1 << 64)) + (open_at + begin).astype(np.uint64) * np.uint64(_STEP))
        values = _truncated(before[open_at] + np.log(rest[open_at]), u, value)
        # Only the best k - found + 1 of these sets can matter.
        wanted = min(k - len(found) + 1, len(values))
        best = np.argpartition(-values, wanted - 1)[:wanted]
        for i in best[np.argsort(-values[best])].tolist():
            place = int(open_at[i] + begin)
            same = parent is not None and place == begin
            if same:
                lost = (*without, tuple(path.own.tolist()))
            else:
                lost = (tuple(pieces[offsets[low + place] : offsets[low + place + 1]].tolist()),)
            made += 1
            heapq.heappush(queue, (-float(values[i]), made, place, path, lost, float(np.exp(path.logs[place])) + (gone if same else 0.0)))
    follows = -queue[0][0] if queue else -np.inf
    return found, follows


def _pieces_of(path: _Path, draws, low: int, high: int) -> np.ndarray:
    offsets, pieces, _ = draws[path.number]
    if path.parent is None:
        return pieces[offsets[low] : offsets[high]]
    if high <= low + path.at:
        return _pieces_of(path.parent, draws, low, high)
    head = _pieces_of(path.parent, draws, low, low + path.at)
    return np.concatenate([head, path.own, pieces[offsets[low + path.at + 1] : offsets[high]]])


def _spelled(pieces: np.ndarray, first_byte: int) -> np.ndarray:
    """Ids of pieces; characters without a piece become their bytes."""
    pieces = np.where((pieces < 0) & (pieces >= -128), first_byte - 1 - pieces, pieces)
    if not (pieces < 0).any():
        return pieces
    out = []
    for p in pieces.tolist():
        out += [p] if p >= 0 else [first_byte + b for b in chr(-p - 1).encode("utf-8", "surrogatepass")]
    return np.array(out, dtype=np.int64)


def sample_texts(trie: Trie, texts: list[str], seeds: list[int], k: int):
    """(text, rank, log_prob, perturbed, log_inclusion, ids) of the samples of some texts."""
    marked = [chr(BLANK) + t.replace(" ", chr(BLANK)) if t else "" for t in texts]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(m) for m in marked])]).astype(np.int64)
    # A word begins at a run of blanks, a line feed and what follows one.
    blank, feed = codes == BLANK, codes == 10
    begins = np.zeros(len(codes) + 1, dtype=bool)
    begins[: len(codes)] = blank | feed
    begins[1 : len(codes)] &= ~(blank[1:] & blank[:-1])
    begins[1:] |= np.append(feed, False)[:-1][: len(codes)] if len(codes) else False
    begins[bounds] = True
    start = np.flatnonzero(begins[: len(codes)])
    stop = np.append(start[1:], len(codes))
    word_of_text = np.searchsorted(start, bounds)
    hashes = Prefix(codes.astype(np.uint64) + np.uint64(1), _CODE_BASE).part(start, stop)
    if trie.lattices is None:
        trie.lattices = Lattices(trie)
    lattices = trie.lattices
    word = lattices.words(hashes, codes, start, stop)
    seeds_of = np.array([s % (1 << 64) for s in seeds], dtype=np.uint64)
    text = np.repeat(np.arange(len(texts)), np.diff(word_of_text))
    place = (np.arange(len(start)) - word_of_text[text]).astype(np.uint64)
    draws = [
        lattices.draw(word, mix(mix(seeds_of[text] + np.uint64((s + 1) * 104729)) + place * np.uint64(_STEP)))
        for s in range(k)
    ]
    for i in range(len(texts)):
        low, high = int(word_of_text[i]), int(word_of_text[i + 1])
        found, follows = _search(draws, lattices, word, low, high, int(seeds_of[i]), k)
        for rank, (path, log, value) in enumerate(found, 1):
            ids = _spelled(_pieces_of(path, draws, low, high), trie.first_byte) if high > low else np.zeros(0, np.int64)
            over = log - follows  # the chance is 1 - exp(-exp(over))
            inclusion = 0.0 if over > 5 else float(over if over < -30 else np.log(-np.expm1(-np.exp(over))))
            yield i, rank, log, value, inclusion, ids


def _sample_rows(vocabulary: Vocabulary, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = trie_of(vocabulary)
        for batch in batches:
            sizes = np.diff(buffers(batch.column("text"))[1])
            part = (np.cumsum(sizes) - sizes) // SLICE_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                texts = [t or "" for t in batch.column("text").slice(low, high - low).to_pylist()]
                seeds = batch.column("seed").slice(low, high - low).to_pylist()
                made = list(sample_texts(trie, texts, seeds, k))
                rows, rank, log, value, inclusion, ids = zip(*made)
                counts = np.array([len(x) for x in ids])
                offsets = np.concatenate([[0], np.cumsum(counts)])
                every = np.concatenate(ids)
                # Decoded here, too: a second pass over the ids would need workers of its own.
                decoded = decode_ids(trie, every, offsets)
                same = [d == texts[i].encode("utf-8", "surrogatepass") for i, d in zip(rows, decoded)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rest").take(pa.array(np.array(rows) + low)), pa.array(rank, pa.int32()),
                        pa.array(counts), pa.array(log, pa.float64()), pa.array(value, pa.float64()),
                        pa.array(inclusion, pa.float64()),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(every.astype(np.int32))),
                        pa.array(same, pa.bool_()),
                    ],
                    ["rest", *RESULTS],
                )

    return run


def sample_segmentations(
    docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text", k: int = 2, seed: int = 0
) -> DataFrame:
    """The columns of ``docs`` but the text, and for each of up to ``k`` distinct segmentations
    ``rank`` (from 1), ``n_pieces``, ``log_prob``, ``perturbed``, ``log_inclusion``, ``ids`` and
    ``round_trip``, whether the ids decode to the text.

    A text with fewer segmentations gives all it has, each with inclusion 1 (log 0) then. A
    null or empty text has one, without pieces. Rows with equal key and text get equal samples;
    a null key is a key. No rows, no samples. A column named like a result gives way to it.
    """
    own = F.xxhash64(F.col("rest").getField(key), F.lit(seed)) if key != text else F.xxhash64("text", F.lit(seed))
    source = numbered(docs, text).select("text", "rest", own.alias("seed"))
    kinds = [T.IntegerType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType(), T.ArrayType(T.IntegerType()), T.BooleanType()]
    schema = source.select("rest").schema
    for name, kind in zip(RESULTS, kinds):
        schema = schema.add(name, kind)
    made = source.mapInArrow(_sample_rows(vocabulary, k), schema)
    return unpacked(made, [c for c in docs.columns if c != text], text, RESULTS)


def decode_ids(trie: Trie, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The UTF-8 bytes of each list of ids, without the blank that encoding puts in front."""
    lengths = trie.lengths[ids]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    data = trie.bytes[np.repeat(trie.starts[ids] - ends[:-1], lengths) + np.arange(ends[-1])].tobytes()
    return [data[ends[a] + (b > a) : ends[b]] for a, b in zip(offsets[:-1], offsets[1:])]


def _decoded_rows(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = trie_of(vocabulary)
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                part = batch.slice(low, 200)
                lists = part.column("ids")
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                offsets = np.concatenate([[0], np.cumsum(counts)])
                texts = decode_ids(trie, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), offsets)
                decoded = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("rest"), decoded], ["rest", "decoded"])

    return run


def decode(samples: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """The columns of ``samples`` but the ids, and ``decoded``: the text that the ids spell. A null
    list of ids gives an empty text. U+2581 comes back as a blank."""
    names = [c for c in samples.columns if c != ids]
    rest = F.struct(*[F.col(f"`{c}`").alias(c) for c in names]) if names else F.struct(F.lit(0).alias("_"))
    slim = samples.select(rest.alias("rest"), F.col(f"`{ids}`").alias("ids"))
    done = slim.mapInArrow(_decoded_rows(vocabulary), slim.select("rest").schema.add("decoded", "string"))
    return unpacked(done, names, ids, ["decoded"])
