"""Alignment of the tokens of two tokenizers, and how often the corpus links two ids.

Both tokenizers spell the same bytes, so their tokens are given by the places where they end.
Places where tokens of both end cut a text into groups; a token of one is linked with all
tokens of the other in its group.

The end arrays are compared along a diagonal: at the index shift of the latest common end a
stretch of one-to-one groups is equal in both arrays, so it is jumped over by comparing blocks
of doubling size, halving them again where they differ. Only the irregular group behind it is
resolved token by token; it sets the shift for the next stretch.

The corpus counts in how many documents a pair of ids is linked. Texts are taken in slices; a
slice has one dictionary of its pairs, and its documents refer to that. The dictionaries are
counted by a shuffle on the pair, the counts go back to the slice by a shuffle on the slice.
No more than a slice (or one long text) is ever in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehandoff.llm.frames import col, stored
from tablehandoff.llm.tokens import byte_encoder, piece_encoder, text_slices, with_blank

# Texts with one dictionary of pairs together, in bytes; a longer text has its own.
SLICE_BYTES = 1 << 21
# Groups with more pairs than this are counted by distinct ids, not pair by pair.
FLAT_PAIRS = 1 << 10

SLICED = (
    "slice long, doc_id {key}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pair array<int>, times array<long>, a array<int>, b array<int>, documents array<int>"
)
RESULT = "doc_id {key}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def irregular_groups(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Rows (first a, behind last a, first b, behind last b) of the groups that are not one to one.

    Both arrays rise, and end with the same number.
    """
    n = len(ends_a)
    width = 4 if not n or ends_a[-1] < 1 << 31 else 8
    kind = np.int32 if width == 4 else np.int64
    raw_a, raw_b = ends_a.astype(kind).tobytes(), ends_b.astype(kind).tobytes()
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    found: list[int] = []
    end = n * width
    i = j = 0
    while i < n:
        # Jump along the diagonal of i and j (equal bytes are equal ends): blocks grow while they
        # are equal, then halve down to the first difference.
        step = width
        x, y = i * width, j * width
        while raw_a[x : x + step] == raw_b[y : y + step] and x < end:
            x, y, step = x + step, y + step, 2 * step
        step >>= 1
        while step >= width and x < end:
            if raw_a[x : x + step] == raw_b[y : y + step]:
                x, y = x + step, y + step
            step >>= 1
        if x >= end:
            break
        i, j = x // width, y // width
        first_a, first_b = i, j
        end_a, end_b = list_a[i], list_b[j]
        while end_a != end_b:
            if end_a < end_b:
                i += 1
                end_a = list_a[i]
            else:
                j += 1
                end_b = list_b[j]
        i, j = i + 1, j + 1
        found += (first_a, i, first_b, j)
    return np.array(found, dtype=np.int64).reshape(-1, 4)


def group_starts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups begin among the tokens of a, and among those of b."""
    groups = irregular_groups(ends_a, ends_b)
    out = []
    for n, first, last in ((len(ends_a), groups[:, 0], groups[:, 1]), (len(ends_b), groups[:, 2], groups[:, 3])):
        inside = np.zeros(n + 1, dtype=np.int64)
        np.add.at(inside, first + 1, 1)
        np.add.at(inside, last, -1)
        out.append(np.flatnonzero(np.cumsum(inside)[:n] == 0))
    return out[0], out[1]


class _Digits:
    """Decimal numbers below 100,000 as bytes, each with room for a separator behind it."""

    def __init__(self, most: int):
        words = [b"%d " % i for i in range(most)]
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(words), dtype=np.uint8)

    def joined(self, ids: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the text, where each number with its separator ends)."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        out = self.bytes[np.repeat(self.places[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        out[ends - 1] = separators
        return out, ends


def _large_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pairs of distinct ids, how often each is linked) of one group with many tokens."""
    ids_a, times_a = np.unique(a, return_counts=True)
    ids_b, times_b = np.unique(b, return_counts=True)
    pairs = (ids_a.astype(np.int64)[:, None] << 32) | ids_b.astype(np.int64)[None, :]
    return pairs.ravel(), (times_a[:, None] * times_b[None, :]).ravel()


def linked_pairs(
    a: np.ndarray, b: np.ndarray, start_a: np.ndarray, start_b: np.ndarray, text: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair of ids as a << 32 | b, links) for all links of all groups; a pair may come in
    several rows. ``text`` is the number of the text of each group."""
    size_a, size_b = np.diff(np.append(start_a, len(a))), np.diff(np.append(start_b, len(b)))
    links = size_a * size_b
    flat = np.flatnonzero(links <= FLAT_PAIRS)
    n = links[flat]
    group = np.repeat(flat, n)
    nth = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    across = size_b[group]
    pairs = (a[start_a[group] + nth // across].astype(np.int64) << 32) | b[start_b[group] + nth % across].astype(np.int64)
    texts, times = text[group], np.ones(len(group), np.int64)
    parts = [(texts, pairs, times)]
    for g in np.flatnonzero(links > FLAT_PAIRS).tolist():
        large, often = _large_pairs(a[start_a[g] : start_a[g] + size_a[g]], b[start_b[g] : start_b[g] + size_b[g]])
        parts.append((np.full(len(large), text[g]), large, often))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _per_text(n: int, text: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    """Sums per text, exact (bincount with weights would round)."""
    if weight is None:
        return np.bincount(text, minlength=n)
    before = np.concatenate([[0], np.cumsum(weight)])
    bounds = np.searchsorted(text, np.arange(n + 1))
    return before[bounds[1:]] - before[bounds[:-1]]


def align_slice(encoder_a, encoder_b, digits: _Digits, data: np.ndarray, offsets: np.ndarray) -> dict:
    """The columns of SLICED but ``slice`` and ``doc_id`` for the texts of a slice: those of the
    documents, one entry for each, and the dictionary of pairs."""
    n = len(offsets) - 1
    data, offsets = with_blank(data, offsets)
    ids_a, first_a, exact_a = encoder_a(data, offsets)
    ids_b, first_b, exact_b = encoder_b(data, offsets)
    usable = exact_a & exact_b & (np.diff(offsets) > 1)
    if not usable.all():  # these have no tokens
        ids_a, ids_b = ids_a[np.repeat(usable, np.diff(first_a))], ids_b[np.repeat(usable, np.diff(first_b))]
        first_a = np.concatenate([[0], np.cumsum(np.where(usable, np.diff(first_a), 0))])
        first_b = np.concatenate([[0], np.cumsum(np.where(usable, np.diff(first_b), 0))])
    # Ends count on over all texts of the slice; the end of a text is common, so no group leaves it.
    start_a, start_b = group_starts(np.cumsum(encoder_a.lengths[ids_a]), np.cumsum(encoder_b.lengths[ids_b]))
    size_a = np.diff(np.append(start_a, len(ids_a)))
    size_b = np.diff(np.append(start_b, len(ids_b)))
    text = np.searchsorted(first_a, start_a, side="right") - 1
    # The notation: tokens of a and b alternate by group.
    of_a, of_b = np.repeat(np.arange(len(start_a)), size_a), np.repeat(np.arange(len(start_b)), size_b)
    where_a = np.arange(len(ids_a)) + start_b[of_a]
    where_b = np.arange(len(ids_b)) + (start_a + size_a)[of_b]
    order, mark = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
    order[where_a], order[where_b] = ids_a, ids_b
    if len(start_a):
        mark[where_a[start_a + size_a - 1]] = ord("|")
        mark[where_b[start_b + size_b - 1]] = ord(";")
    notation, ends = digits.joined(order, mark)
    cuts = np.concatenate([[0], ends])[first_a + first_b].tolist()
    raw = notation.tobytes()
    hashes = [hashlib.sha256(raw[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(cuts, cuts[1:])]
    texts, pairs, times = linked_pairs(ids_a, ids_b, start_a, start_b, text)
    known, pair = np.unique(pairs, return_inverse=True)
    key = texts * max(len(known), 1) + pair
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    own = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.add.reduceat(times, own) if len(own) else times
    texts, pair = key[own] // max(len(known), 1), key[own] % max(len(known), 1)
    return {
        "n_a": np.diff(first_a), "n_b": np.diff(first_b), "n_groups": _per_text(n, text), "n_links": _per_text(n, texts, times),
        "groups_sha256": hashes, "first": np.searchsorted(texts, np.arange(n + 1)), "pair": pair, "times": times,
        "a": known >> 32, "b": known & 0xFFFFFFFF, "documents": np.bincount(pair, minlength=len(known)),
    }


def _lists(first: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))


def _slices(file_a: str, file_b: str, key: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder_a, encoder_b = byte_encoder(file_a, plain_specials=True), piece_encoder(file_b)
        digits = _Digits(max(len(encoder_a.lengths), len(encoder_b.lengths)))
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text"), SLICE_BYTES):
                made = align_slice(encoder_a, encoder_b, digits, data, offsets)
                n, number = high - low, number + 1
                none = np.zeros(n + 1)
                # The documents of the slice, then a row with its dictionary.
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, number)), batch.column("doc_id").slice(low, n).cast(key),
                        *[pa.array(made[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                        pa.array(made["groups_sha256"]), _lists(made["first"], made["pair"], pa.int32()),
                        _lists(made["first"], made["times"], pa.int64()), *[_lists(none, [], pa.int32())] * 3,
                    ],
                    NAMES,
                )
                one, every = np.zeros(2), np.array([0, len(made["a"])])
                if every[1]:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([number]), pa.nulls(1, key), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()),
                            _lists(one, [], pa.int32()), _lists(one, [], pa.int64()),
                            *[_lists(every, made[c], pa.int32()) for c in ("a", "b", "documents")],
                        ],
                        NAMES,
                    )

    return run


NAMES = [part.split()[0] for part in SLICED.split(", ")]


def _counted(documents: pa.Table, dictionary: pa.Table) -> pa.Table:
    """The results of the documents of one slice, given the corpus counts of its pairs."""
    count, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if dictionary.num_rows:
        place = dictionary.column("place").to_numpy()
        count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place] = dictionary.column("count").to_numpy()
        best[place] = dictionary.column("best").to_numpy().astype(np.int64)
    lists = documents.column("pair").combine_chunks()
    pair = lists.flatten().to_numpy()
    times = documents.column("times").combine_chunks().flatten().to_numpy()
    text = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    sums = [_per_text(len(lists), text, times * x[pair]) for x in (best, count)]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    done = {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1])}
    return pa.table([done.get(c, documents.column(c) if c in documents.column_names else None) for c in names], names)


def align(docs: DataFrame, file_a: str, file_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row of ``docs`` the groups and links between the tokens of two tokenizers.

    ``doc_id``, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best`` (links whose count is
    the highest of their a id, ties included), ``count_sum`` (over the links) and ``groups_sha256`` of
    ``a1,a2|b1;a3|b2,b3``. The count of a pair of ids is the number of rows that link it.

    a is a byte-level vocabulary applied to a blank and the text, b a piece model that adds that
    blank; special tokens in a text are plain text. Null and empty texts, and texts that the
    tokens of either do not spell (U+2581, say), have no tokens: zeros, and an empty hash.
    Repeated rows are rows of their own, a null key is a key; other columns are not read, no
    rows give no rows. A text of any length is taken whole: it needs about 150 bytes of a
    worker's memory a byte.
    """
    source = docs.select(col(key).alias("doc_id"), col(text).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    arrow = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    if arrow == pa.string():
        source, kind = source.withColumn("doc_id", F.col("doc_id").cast("string")), "string"
    sliced = stored(source.mapInArrow(_slices(file_a, file_b, arrow), SLICED.format(key=kind)), "links")
    pairs = sliced.where(F.size("a") > 0).select("slice", F.posexplode(F.arrays_zip("a", "b", "documents")).alias("pair", "p"))
    pairs = pairs.select("slice", "pair", "p.a", "p.b", "p.documents")
    counts = stored(pairs.groupBy("a", "b").agg(F.sum("documents").alias("count")), "counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))  # no more rows than the vocabulary has ids
    ranked = counts.join(F.broadcast(highest), "a").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))
    dictionary = pairs.join(ranked, ["a", "b"]).select(F.col("slice").alias("of"), F.col("pair").alias("place"), "count", "best")
    documents = sliced.where(F.col("n_a").isNotNull()).drop("a", "b", "documents")
    return documents.groupBy("slice").cogroup(dictionary.groupBy("of")).applyInArrow(_counted, RESULT.format(key=kind))
