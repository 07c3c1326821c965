"""Long word sequences that occur more than once, taken out everywhere.

The words of the corpus form a de Bruijn graph whose nodes are sampled word k-mers: of the
``width - K + 1`` k-mers of a window the one with the least hash, so that equal windows
sample the same node at the same place. The windows around one occurrence of a node are an
edge (a *zone*: the words they cover). Equal zones are one edge with a multiplicity: what
does not branch compacts into a single row by an aggregate, whatever the number of its
copies. An edge of multiplicity two or more is repeated as a whole. Only where a node has
several different edges (it branches) the windows of the edges are compared one by one,
those of a repeated edge once, not once per copy. Places in the source texts verify the
spans: an occurrence is marked from the hashes of its own words only.

Texts are shuffled once; the rows that are grouped are one per zone (about a twelfth of the
words), and counts combine before the shuffle. Hash of zone and hash of node must both agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehandoff.llm.frames import numbered, stored, unpacked
from tablehandoff.llm.words import WORD_BASE, Prefix, Words, slices

K = 12  # words of a sampled k-mer
PLACE_BITS = 24  # low bits of a packed minimum hold a place
PIECE = 1 << 22  # a text of more words is handled in pieces that overlap by a window
WINDOWS_BITS = 8  # low bits of a packed zone hold its number of windows

ZONE_SCHEMA = "row long, anchor long, zone long, at long"
WINDOW_SCHEMA = "row long, anchor long, win long, start long, weight int"


def _least(packed: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive numbers."""
    done = 1
    while done * 2 <= width:
        packed = np.minimum(packed[:-done], packed[done:])
        done *= 2
    rest = width - done
    return np.minimum(packed[:-rest], packed[rest:]) if rest else packed


def _zones(hashes: np.ndarray, owner: np.ndarray, width: int):
    """First window, number of windows, node and hash of each zone of a run of texts.

    ``owner`` tells the text of each word; windows stay inside one text.
    """
    empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    n = len(hashes) - width + 1
    if n <= 0:
        return empty
    prefix = Prefix(hashes, WORD_BASE)
    k = min(K, width)
    nodes = prefix.windows(k)
    bits = np.uint64(PLACE_BITS)
    packed = (nodes >> bits << bits) | np.arange(len(nodes), dtype=np.uint64)
    place = (_least(packed, width - k + 1) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    valid = owner[:n] == owner[width - 1 :]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (place[1:] != place[:-1])
    first, final = np.flatnonzero(new), np.flatnonzero(last)
    if not len(first):
        return empty
    return first, final - first + 1, nodes[place[first]], prefix.part(first, final + width)


def _pieces(words: Words, width: int) -> Iterator[tuple[int, int]]:
    """Word ranges that hold each window of the slice once; more than one only for a very long text."""
    low, total = 0, len(words.hashes)
    while True:
        high = min(low + PIECE, total)
        yield low, min(high + width - 1, total)
        low = high
        if low >= total:
            return


def zone_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for low, high, words in slices(batch.column(1)):
                owner = np.repeat(np.arange(high - low), words.counts)
                for a, b in _pieces(words, width):
                    first, count, node, zone = _zones(words.hashes[a:b], owner[a:b], width)
                    first = first + a
                    text = owner[first]
                    start = first - words.first[text]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(rows[low + text]),
                            pa.array(node.view(np.int64)),
                            pa.array(zone.view(np.int64)),
                            pa.array((start << WINDOWS_BITS) | count),
                        ],
                        ["row", "anchor", "zone", "at"],
                    )

    return run


def window_rows(width: int):
    """The windows of the listed zones of each text, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lists = batch.column(0).to_numpy(), batch.column(2)
            for low, high, words in slices(batch.column(1)):
                prefix = Prefix(words.hashes, WORD_BASE)
                part = lists.slice(low, high - low)
                flat = part.flatten()
                at, anchor, weight = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                text = np.repeat(np.arange(high - low), part.value_lengths().to_numpy())
                count = at & ((1 << WINDOWS_BITS) - 1)
                each = np.repeat(np.arange(len(at)), count)
                within = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
                start = (at >> WINDOWS_BITS)[each] + within
                place = start + words.first[:-1][text[each]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[low + text[each]]),
                        pa.array(anchor[each]),
                        pa.array(prefix.part(place, place + width).view(np.int64)),
                        pa.array(start),
                        pa.array(weight[each].astype(np.int32)),
                    ],
                    ["row", "anchor", "win", "start", "weight"],
                )

    return run


def cut_rows(width: int):
    """Each text without the words of its spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(3)
            lengths = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = spans.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            for low, high, words in slices(batch.column(1)):
                n_removed, texts = np.zeros(high - low, np.int64), []
                for i in range(high - low):
                    own = words.data[words.offsets[i] : words.offsets[i + 1]].tobytes().split()
                    at = flat[ends[low + i] - lengths[low + i] : ends[low + i]]
                    if len(at):
                        start = at >> WINDOWS_BITS
                        end = start + (at & ((1 << WINDOWS_BITS) - 1)) - 1 + width
                        change = np.zeros(len(own) + 1, np.int64)
                        np.add.at(change, start, 1)
                        np.add.at(change, end, -1)
                        keep = np.cumsum(change[:-1]) == 0
                        n_removed[i] = len(own) - int(keep.sum())
                        own = compress(own, keep.tolist())
                    texts.append(b" ".join(own))
                kept = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(low, high - low),
                        batch.column(2).slice(low, high - low),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(n_removed),
                        kept,
                    ],
                    ["text", "rest", "n_words", "n_removed", "kept_text"],
                )

    return run


def remove_repeats(docs: DataFrame, text: str = "text", width: int = 35) -> DataFrame:
    """The columns of ``docs`` and ``n_words``, ``n_removed`` and ``kept_text``.

    A window is ``width`` consecutive words of one row. Every word that a window covers whose
    words also start anywhere else, in the same row or another, is removed; windows are
    judged on the input. ``kept_text`` is what is left, joined by single blanks.

    Null and empty texts and texts of fewer words than a window keep all they have. Rows that
    are equal in all columns are texts of their own, and so repeat each other. An empty table
    gives an empty result. A column of ``docs`` named like a result gives way to it.
    """
    source = numbered(docs, text)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    zones = source.select("row", "text").mapInArrow(zone_rows(width), ZONE_SCHEMA)
    # A node with one edge once cannot be part of a repeat. One edge several times: it does
    # not branch, and all its copies are repeated. Several edges: it branches.
    nodes = stored(
        zones.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), F.min("zone").alias("low"), F.max("zone").alias("high"))
        .where(F.col("n") > 1)
        .select("anchor", (F.col("low") != F.col("high")).alias("branches")),
        "nodes",
    )
    found = stored(zones.join(nodes, "anchor"), "zones")
    branching = found.where("branches")
    edges = stored(
        branching.groupBy("anchor", "zone").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("one")), "edges"
    )
    counted = branching.join(edges, ["anchor", "zone"])
    several = F.col("n") > 1
    whole = found.where(~F.col("branches")).select("row", "at").unionByName(
        counted.where(several).select("row", "at")
    )

    texts = source.repartition(parts, "row")
    # Zones to compare window by window: all that occur once, and one copy of the others.
    asked = (
        counted.where(~several | (F.col("row") == F.col("one")))
        .groupBy("row")
        .agg(F.collect_list(F.struct("at", "anchor", F.when(several, 2).otherwise(1).alias("weight"))).alias("asked"))
    )
    windows = texts.select("row", "text").join(asked, "row").mapInArrow(window_rows(width), WINDOW_SCHEMA)
    again = stored(
        windows.groupBy("anchor", "win").agg(F.sum("weight").alias("n")).where(F.col("n") > 1).select("anchor", "win"),
        "again",
    )
    single = windows.where(F.col("weight") == 1).join(again, ["anchor", "win"])
    spans = (
        whole.unionByName(single.select("row", (F.shiftleft("start", WINDOWS_BITS) + 1).alias("at")))
        .groupBy("row").agg(F.collect_list("at").alias("spans"))
    )
    schema = source.select("text", "rest").schema
    for name, kind in (("n_words", "long"), ("n_removed", "long"), ("kept_text", "string")):
        schema = schema.add(name, kind)
    cut = texts.join(spans, "row", "left").select("row", "text", "rest", "spans").mapInArrow(cut_rows(width), schema)
    return unpacked(cut, docs.columns, text, ["n_words", "n_removed", "kept_text"])
