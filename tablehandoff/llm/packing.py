"""Token sequences of one length from documents, as a cutting-stock problem.

The ids of a document are cut into whole sequences and a rest. The rests, by their number of
ids, are the demand: at most ``size - 1`` numbers, whatever the table. A linear program over
patterns (how many rests of which lengths share a sequence) covers the demand with the fewest
sequences. Its columns are generated: the program is solved over the patterns found so far, and
a knapsack by dynamic programming, with the duals as values, finds the pattern that helps most.

The solution is rounded down. A rest has a rank among those of its length; the ranks of a length
are dealt out to the patterns in order, so sequence and offset follow from length and rank by
arithmetic. Rests that rounding leaves over are laid end to end and cut at will: first into the
gaps of the patterns, then into further sequences. If the gaps hold more than is left over (rests
that do not fit each other), some patterns are taken apart again, so only the last sequence can
be padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablehandoff.llm.frames import col, stored
from tablehandoff.llm.tokens import byte_encoder, text_slices

SLICE_BYTES = 1 << 21
# The program ends when no pattern can save more than this share of the sequences.
GAP = 1e-3
# Rounds for each length; what the program has by then is used, since cuts mend the rest.
ROUNDS = 2


def best_pattern(values: np.ndarray, lengths: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """The copies of each length (rising) that fit ``size`` and have the largest value together."""
    best, taken = np.zeros(size + 1), np.full(size + 1, -1)
    fits = np.searchsorted(lengths, np.arange(size + 1), side="right")
    for room in range(1, size + 1):
        best[room] = best[room - 1]
        if fits[room]:
            sums = best[room - lengths[: fits[room]]] + values[: fits[room]]
            item = int(sums.argmax())
            if sums[item] > best[room]:
                best[room], taken[room] = sums[item], item
    copies, room = np.zeros(len(lengths), np.int64), size
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            copies[taken[room]] += 1
            room -= int(lengths[taken[room]])
    return float(best[size]), copies


def first_patterns(lengths: np.ndarray, demand: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns to start from: the longest lengths that still fit, used until one is covered.

    Pattern i covers length i, and later ones hold none of the covered lengths.
    """
    n = len(lengths)
    # Unequal small additions keep two lengths from being covered at once.
    left = demand + 1e-6 * np.arange(1, n + 1) / max(n, 1)
    patterns, used, open_ = np.zeros((n, n), np.int64), np.zeros(n), np.arange(n)
    while len(open_):
        room, copies = size, np.zeros(n, np.int64)
        while (fits := int(np.searchsorted(lengths[open_], room, side="right"))) > 0:
            item = open_[fits - 1]
            copies[item] = room // lengths[item]
            room -= int(copies[item] * lengths[item])
        taken = np.flatnonzero(copies)
        ratios = left[taken] / copies[taken]
        covered = int(taken[ratios.argmin()])
        patterns[covered], used[covered] = copies, ratios.min()
        left = left - used[covered] * copies
        open_ = open_[open_ != covered]
    return patterns, used


def cover(lengths: np.ndarray, demand: np.ndarray, size: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as rows of copies, how often each is used, not rounded): the least number of
    sequences that hold ``demand`` rests of each length."""
    n = len(lengths)
    patterns, used = first_patterns(lengths, demand, size)
    inverse = np.linalg.inv(patterns.T.astype(np.float64))
    for _ in range(ROUNDS * n):
        duals = inverse.sum(axis=0)
        value, copies = best_pattern(duals, lengths, size)
        # No solution needs fewer sequences than sum / value, nor than the ids fill.
        least = max(used.sum() / max(value, 1.0), (lengths * demand).sum() / size)
        if value <= 1 + 1e-9 or used.sum() - least <= gap * used.sum():
            break
        change = inverse @ copies
        able = np.flatnonzero(change > 1e-9)
        ratios = used[able] / change[able]
        step, leaves = float(ratios.min()), int(able[ratios.argmin()])
        used = np.maximum(used - step * change, 0.0)
        used[leaves] = step
        row = inverse[leaves] / change[leaves]
        inverse -= np.outer(change, row)
        inverse[leaves] = row
        patterns[leaves] = copies
    return patterns, used


class Plan(NamedTuple):
    """Where a rest lies, by its length and rank.

    ``cells`` (rows sorted by length and first rank): length, first rank, copies in a sequence,
    first sequence, offset of the first copy. ``spare`` and ``before``: by length, the first rank
    that is left over and the ids left over of smaller lengths. ``gaps``: first id among those left
    over, width, first sequence, offset; the last one stands for whole sequences.
    """

    size: int
    cells: np.ndarray
    spare: np.ndarray
    before: np.ndarray
    gaps: np.ndarray
    sequences: int


def plan(histogram: dict[int, int], size: int, gap: float = GAP) -> Plan:
    """The patterns for rests of 1 to ``size - 1`` ids: how many there are of each length."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[int(x)] for x in lengths], dtype=np.int64)
    patterns, used = cover(lengths, demand, size, gap)
    times = np.floor(used + 1e-7).astype(np.int64)
    # Rounding errors must not use a rest twice.
    while len(lengths) and (over := (times @ patterns) - demand).max() > 0:
        short = int(over.argmax())
        times[np.flatnonzero((patterns[:, short] > 0) & (times > 0))[0]] -= 1
    width = size - patterns @ lengths
    left = demand - times @ patterns
    while (missing := int((times * width).sum() - (left * lengths).sum())) > 0:
        worst = int(np.where(times > 0, width, -1).argmax())
        apart = min(int(times[worst]), -(-missing // size))
        times[worst] -= apart
        left += apart * patterns[worst]
    cells, gaps, sequences, spread = [], [], 0, 0
    taken = np.zeros(len(lengths), np.int64)
    for p in np.flatnonzero(times).tolist():
        offset = 0
        for i in np.flatnonzero(patterns[p])[::-1].tolist():
            copies = int(patterns[p, i])
            cells.append((int(lengths[i]), int(taken[i]), copies, sequences, offset))
            taken[i] += copies * times[p]
            offset += copies * int(lengths[i])
        if width[p]:
            gaps.append((spread, int(width[p]), sequences, offset))
            spread += int(width[p] * times[p])
        sequences += int(times[p])
    gaps.append((spread, size, sequences, 0))
    spare, before = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
    spare[lengths] = taken
    before[lengths] = np.cumsum(left * lengths) - left * lengths
    sequences += -(-int((left * lengths).sum() - spread) // size)
    cells = np.array(sorted(cells), dtype=np.int64).reshape(-1, 5)
    return Plan(size, cells, spare, before, np.array(gaps, dtype=np.int64), sequences)


def places(made: Plan, length: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
    """(start in the rest, ids, sequence, offset) of the pieces of one rest."""
    if rank < made.spare[length]:
        cell = int(np.searchsorted(made.cells[:, 0] * (1 << 44) + made.cells[:, 1], length * (1 << 44) + rank, side="right")) - 1
        _, first, copies, sequence, offset = made.cells[cell].tolist()
        nth = rank - first
        yield 0, length, sequence + nth // copies, offset + nth % copies * length
        return
    at = int(made.before[length]) + (rank - int(made.spare[length])) * length
    start = 0
    while start < length:
        gap = int(np.searchsorted(made.gaps[:, 0], at, side="right")) - 1
        first, width, sequence, offset = made.gaps[gap].tolist()
        inside = (at - first) % width
        n = min(length - start, width - inside)
        yield start, n, sequence + (at - first) // width, offset + inside
        start, at = start + n, at + n


ROWS = "part long, doc_id {key}, doc_tokens long, rest int, nth long, whole_before long, whole array<long>, ids binary"


def _tokens(file: str, size: int, key: pa.DataType):
    """Each document cut into whole sequences, of which the checksums are kept, and a rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(file)
        part = TaskContext.get().partitionId()
        seen, whole_before = np.zeros(size, np.int64), 0
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text"), SLICE_BYTES):
                ids, first, _ = encoder(data, offsets)
                columns: list[list] = [[], [], [], [], [], []]
                for a, b in zip(first.tolist(), first[1:].tolist()):
                    own = np.append(ids[a:b], 0).astype("<u4")
                    cut = len(own) // size * size
                    rest = len(own) - cut
                    whole = [zlib.crc32(own[x : x + size].tobytes()) for x in range(0, cut, size)]
                    row = (len(own), rest, int(seen[rest]), whole_before, whole, own[cut:].tobytes())
                    for column, value in zip(columns, row):
                        column.append(value)
                    seen[rest] += 1
                    whole_before += len(whole)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(high - low, part)), batch.column("doc_id").slice(low, high - low).cast(key),
                        *[pa.array(c, k) for c, k in zip(columns, kinds)],
                    ],
                    ["part", "doc_id", "doc_tokens", "rest", "nth", "whole_before", "whole", "ids"],
                )

    return run


def _pieces(made: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["start", "length", "ids_crc32", "sequence_id", "offset"]
        for batch in batches:
            row, columns = [], [[] for _ in names]
            picked = zip(*[batch.column(c).to_pylist() for c in ("rest", "rank", "whole_rank", "whole", "ids")])
            for i, (rest, rank, whole_rank, whole, ids) in enumerate(picked):
                found = [(n * made.size, made.size, crc, made.sequences + whole_rank + n, 0) for n, crc in enumerate(whole)]
                if rest:
                    cut = len(whole) * made.size
                    found += [
                        (cut + a, n, zlib.crc32(ids[4 * a : 4 * (a + n)]), sequence, offset)
                        for a, n, sequence, offset in places(made, rest, rank)
                    ]
                row += [i] * len(found)
                for column, values in zip(columns, zip(*found)):
                    column += values
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(row), *[pa.array(c, pa.int64()) for c in columns[:3]],
                 batch.column("doc_tokens").take(row), *[pa.array(c, pa.int64()) for c in columns[3:]]],
                ["doc_id", *names[:3], "doc_tokens", *names[3:]],
            )

    return run


def pack(docs: DataFrame, file: str, size: int = 1024, key: str = "doc_id", text: str = "text", gap: float = GAP) -> DataFrame:
    """The pieces of all rows of ``docs`` in sequences of at most ``size`` ids.

    ``doc_id``, ``start`` (ids of the document before the piece), ``length``, ``ids_crc32`` (of the
    ids as little-endian 32-bit numbers), ``doc_tokens``, ``sequence_id`` (from 0, gapless) and
    ``offset`` (in the sequence). A document is its ids by the byte-level vocabulary ``file`` and an
    id 0; special tokens in a text are those tokens, as the vocabulary says.

    A null text counts as empty and has the id 0 alone. Repeated rows are packed each, a null key
    is a key, other columns are not read, and no rows give no pieces. Every sequence but at most
    one is full. A text of any length is encoded whole by one task; it is spread over as many
    sequences as it fills.
    """
    source = docs.select(col(key).alias("doc_id"), col(text).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    if arrow == pa.string():
        source, kind = source.withColumn("doc_id", F.col("doc_id").cast("string")), "string"
    rows = stored(source.mapInArrow(_tokens(file, size, arrow), ROWS.format(key=kind)), "tokens")
    counts = rows.groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("whole")).alias("whole"))
    counts = stored(counts, "counts")
    # One row for each length: less than ``size`` rows.
    histogram = {r.rest: r.n for r in counts.where(F.col("rest") > 0).groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    made = plan(histogram, size, gap)
    # Ranks: rows of the same length in earlier parts, and earlier in the own part.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.select("part", "rest", "n").unionByName(
        counts.groupBy("part").agg(F.sum("whole").alias("n")).select("part", F.lit(size).alias("rest"), "n")
    )
    starts = cells.withColumn("start", F.coalesce(F.sum("n").over(before.partitionBy("rest")), F.lit(0)))
    starts = starts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("rest", "start"))).alias("starts"))
    ranked = rows.join(starts, "part").select(
        "doc_id", "doc_tokens", "rest", "whole", "ids",
        (F.col("starts")[F.col("rest")] + F.col("nth")).alias("rank"),
        (F.col("starts")[F.lit(size)] + F.col("whole_before")).alias("whole_rank"),
    )
    return ranked.mapInArrow(
        _pieces(made),
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
