"""Classes of near copies: BagMinHash signatures, banding, exact verification.

A text is a bag of word shingles. Its signature has a least value for each slot over all
units of weight of all shingles, so two signatures agree in a slot with the chance of the
weighted Jaccard similarity of the bags. The values come from Poisson processes: the weights
are cut into the intervals [0,1), [1,2), [2,4), [4,8), ..., each with a process of a rate in
proportion to its length, whose points carry a slot and a place in the interval found by
halving; points beyond the weight do not count. A process runs in order of time and stops
once it is behind the largest slot, so a text costs a few points for each shingle, not one for
each shingle and slot.

Texts that agree in a band share a bucket and are candidates. Texts of equal words are one
text from the start. The center of a bucket is the text that shares buckets with most others.
Each text is first verified against one center (a star, so copies are not expanded into
pairs). What is left are pairs that share a bucket and are in different classes. Of those,
a pair is compared if it can reach the similarity at all: texts share no more than the
shingles that each of them has in common with any candidate, and lack each shingle whose bit
in a map of hashes the other lacks. Then the slots of both are compared: they agree in a share
of the slots that estimates the similarity, and a pair that agrees in far too few is dropped
before a text is fetched. With 40 bands of 6 a pair at similarity 0.8 is missed by the bands with
a chance of 5 in a million, and by its slots with one of less than 1 in a billion.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehandoff.llm.components import components
from tablehandoff.llm.decontaminate import similarity
from tablehandoff.llm.frames import numbered, stored
from tablehandoff.llm.words import WORD_BASE, Prefix, Words, mix, slices

SHINGLE = 5
BANDS = 40
ROWS = 6
SLOTS = BANDS * ROWS
# Bits of the map that bounds what two texts can have in common.
BITS = 1024
SECOND_BASE = 0xA3EC647659359ACD
_STEP = 0x9E3779B97F4A7C15

# A pair is dropped if its agreeing slots are so many standard deviations below those expected at
# the similarity asked for: 192 of 240 at 0.8, less 6.5 times 6.2.
DEVIATIONS = 6.5

SIGNATURE = "row long, n long, c1 long, c2 long, bands array<long>, slots binary"


def bags(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle hash) of every shingle. A text of fewer words than ``size`` is one shingle."""
    prefix = Prefix(words.hashes, WORD_BASE)
    counts = words.counts
    n = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    text = np.repeat(np.arange(len(counts)), n)
    start = words.first[text] + np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    return text, prefix.part(start, start + np.minimum(size, counts[text]))


def _intervals(text: np.ndarray, shingle: np.ndarray):
    """The distinct shingles of each text as (text, seed, rate, part that counts) of intervals."""
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(np.append(at, len(text)))
    text, shingle = text[at], shingle[at]
    out = [(text, mix(shingle), np.ones(len(text)), np.ones(len(text)))]
    start, level = 1, 1
    while len(text):
        more = weight > start
        text, shingle, weight = text[more], shingle[more], weight[more]
        length = start  # [1,2), [2,4), [4,8), ...
        seed = mix(shingle + np.uint64((level * _STEP) % (1 << 64)))
        out.append((text, seed, np.full(len(text), float(length)), np.minimum(1.0, (weight - start) / length)))
        start, level = start * 2, level + 1
    return [np.concatenate(x) for x in zip(*out)]


def signatures(text: np.ndarray, shingle: np.ndarray, n_texts: int, slots: int = SLOTS) -> np.ndarray:
    """The slots of each text; infinite for a text without shingles."""
    text, seed, rate, part = _intervals(text, shingle)
    best = np.full(n_texts * slots, np.inf)
    time = np.zeros(len(text))
    step = 0
    while len(text):
        # Few processes are left: several points at once, or short texts would take many rounds.
        points = int(min(64, max(1, 4096 // len(text))))
        draws = np.arange(step, step + points, dtype=np.uint64)
        first = mix(seed[:, None] + (2 * draws + np.uint64(1)) * np.uint64(_STEP))
        gaps = -np.log(((first >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (rate * slots)[:, None]
        times = time[:, None] + np.cumsum(gaps, axis=1)
        second = mix(seed[:, None] + (2 * draws + np.uint64(2)) * np.uint64(_STEP))
        slot = ((second >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
        counts = (second & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 < part[:, None]
        where = (text[:, None] * slots + slot)[counts]
        np.minimum.at(best, where, times[counts])
        time, step = times[:, -1], step + points
        present = np.unique(text)
        largest = np.empty(n_texts)
        largest[present] = best.reshape(n_texts, slots)[present].max(axis=1)
        go = time < largest[text]
        text, seed, rate, part, time = text[go], seed[go], rate[go], part[go], time[go]
    return best.reshape(n_texts, slots)


def band_keys(best: np.ndarray, bands: int) -> np.ndarray:
    """A hash of each band of each signature."""
    values = best.astype(np.float32).view(np.uint32).astype(np.uint64).reshape(len(best), bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(_STEP)
    key = np.broadcast_to(key, values.shape[:2])
    for i in range(values.shape[2]):
        key = mix((key ^ values[:, :, i]) * np.uint64(WORD_BASE) + np.uint64(i + 1))
    return key


def slot_marks(best: np.ndarray) -> np.ndarray:
    """16 bits of each slot: equal slots have equal marks, others with a chance of 1 in 65,536."""
    values = best.astype(np.float32).view(np.uint32).astype(np.uint64)
    return (mix(values * np.uint64(WORD_BASE)) >> np.uint64(48)).astype(np.uint16)


def fewest_agreeing(least: float) -> int:
    """Slots that two texts of similarity ``least`` agree in, but for a negligible chance."""
    return int(np.floor(SLOTS * least - DEVIATIONS * np.sqrt(SLOTS * least * (1 - least))))


def _agreeing_rows(fewest: int):
    """The pairs whose signatures agree in ``fewest`` slots or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, SLOTS)
                for c in ("slots_a", "slots_b")
            ]
            agree = (sides[0] == sides[1]).sum(axis=1) >= fewest
            yield batch.select(["a", "b"]).filter(pa.array(agree))

    return run


def _agreeing(pairs: DataFrame, signed: DataFrame, least: float) -> DataFrame:
    """The pairs that their signatures do not rule out."""
    second = pairs.join(signed.select(F.col("row").alias("b"), F.col("slots").alias("slots_b")), "b")
    both = second.join(signed.select(F.col("row").alias("a"), F.col("slots").alias("slots_a")), "a")
    return both.select("a", "b", "slots_a", "slots_b").mapInArrow(_agreeing_rows(fewest_agreeing(least)), "a long, b long")


def _signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column(0)
        for low, high, words in slices(batch.column(1)):
            best = signatures(*bags(words, SHINGLE), high - low)
            keys = band_keys(best, BANDS).view(np.int64).ravel()
            marks = slot_marks(best).tobytes()
            whole = [
                Prefix(words.hashes, base).part(words.first[:-1], words.first[1:]).view(np.int64)
                for base in (WORD_BASE, SECOND_BASE)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.slice(low, high - low), pa.array(words.counts.astype(np.int64)), pa.array(whole[0]), pa.array(whole[1]),
                    pa.ListArray.from_arrays(pa.array(np.arange(high - low + 1, dtype=np.int32) * BANDS), pa.array(keys)),
                    pa.array([marks[i : i + 2 * SLOTS] for i in range(0, len(marks), 2 * SLOTS)], pa.binary()),
                ],
                ["row", "n", "c1", "c2", "bands", "slots"],
            )


def _linked_rows(least: float):
    """The pairs whose texts reach ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [list(_bags_of(batch.column(c))) for c in ("text_a", "text_b")]
            keep = [i for i, (x, y) in enumerate(zip(*parts)) if similarity(x, y) >= least]
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


def _bags_of(texts: pa.Array) -> Iterator[np.ndarray]:
    """The shingles of each text."""
    for low, high, words in slices(texts):
        text, shingle = bags(words, SHINGLE)
        yield from np.split(shingle, np.searchsorted(text, np.arange(1, high - low)))


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    second = pairs.join(texts.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
    both = second.join(texts.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_linked_rows(least), "a long, b long")


def _in_class(rows: DataFrame, name: str, classes: DataFrame) -> DataFrame:
    """Adds ``<name>_class``: the class of node ``name``, itself if it is linked to none."""
    to = classes.select(F.col("a").alias(name), F.col("b").alias("_to"))
    return rows.join(to, name, "left").withColumn(f"{name}_class", F.coalesce("_to", name)).drop("_to")


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct shingle of each text and how often it is there."""
    for batch in batches:
        rows = batch.column(0).to_numpy()
        for low, _, words in slices(batch.column(1)):
            text, shingle = bags(words, SHINGLE)
            order = np.lexsort((shingle, text))
            text, shingle = text[order], shingle[order]
            new = np.ones(len(text), dtype=bool)
            new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
            at = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[low + text[at]]), pa.array(shingle[at].view(np.int64)), pa.array(np.diff(np.append(at, len(text))))],
                ["row", "shingle", "weight"],
            )


def _bit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text a map of BITS bits: those of its shingles' hashes."""
    for batch in batches:
        rows = batch.column(0)
        for low, high, words in slices(batch.column(1)):
            text, shingle = bags(words, SHINGLE)
            bits = np.zeros((high - low, BITS), dtype=bool)
            bits[text, (shingle % np.uint64(BITS)).astype(np.int64)] = True
            longs = np.packbits(bits, axis=1).view(np.int64).ravel()
            offsets = pa.array(np.arange(high - low + 1, dtype=np.int32) * (BITS // 64))
            yield pa.RecordBatch.from_arrays(
                [rows.slice(low, high - low), pa.ListArray.from_arrays(offsets, pa.array(longs))], ["id", "bits"]
            )


def _open_pairs(buckets: DataFrame, texts: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) that share a bucket, are in different classes and can reach ``least``."""
    placed = stored(_in_class(buckets.select("key", "id", "center"), "id", classes), "placed")
    mixed = stored(
        placed.groupBy("key")
        .agg(
            F.min("id_class").alias("low"), F.max("id_class").alias("high"),
            F.max(F.when(F.col("id") == F.col("center"), F.col("id_class"))).alias("main"),
        )
        .where("low <> high").select("key", "main"),
        "mixed",
    )
    rows = stored(placed.select("key", "id", "id_class").join(mixed, "key"), "mixed-rows")
    asked = texts.join(rows.select(F.col("id").alias("row")).distinct(), "row", "left_semi")
    bags_of = asked.select("row", "text").mapInArrow(_shingle_rows, "row long, shingle long, weight long")
    common = stored(
        bags_of.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("shingle", F.lit(True).alias("common")),
        "common",
    )
    # Of each text: its shingles, and those that another candidate has as well.
    held = stored(
        bags_of.join(common, "shingle", "left").groupBy(F.col("row").alias("id"))
        .agg(F.sum("weight").alias("whole"), F.sum(F.when(F.col("common"), F.col("weight")).otherwise(0)).alias("held"))
        .where(F.col("held") >= least * F.col("whole") - 1e-9),
        "held",
    )
    maps = asked.select("row", "text").mapInArrow(_bit_rows, "id long, bits array<long>")
    able = stored(rows.join(stored(held.join(maps, "id"), "bounds"), "id"), "able")
    # One side is what is not in the class of the bucket's center: few after the first links.
    left = able.where("id_class <> main").select(
        "key", F.col("id").alias("x"), F.col("id_class").alias("x_class"), F.col("whole").alias("x_whole"), F.col("held").alias("x_held"),
        *[F.col("bits")[i].alias(f"x{i}") for i in range(BITS // 64)],
    )
    right = able.select(
        F.col("key").alias("y_key"), F.col("id").alias("y"), F.col("id_class").alias("y_class"), "main",
        F.col("whole").alias("y_whole"), F.col("held").alias("y_held"),
        *[F.col("bits")[i].alias(f"y{i}") for i in range(BITS // 64)],
    )
    # A bit of one map that the other lacks is a shingle that the other lacks.
    lacks = lambda a, b: sum(
        (F.bit_count(F.col(f"{a}{i}").bitwiseAND(F.bitwise_not(f"{b}{i}"))) for i in range(BITS // 64)), F.lit(0)
    )
    both = F.least("x_held", "y_held", F.col("x_whole") - lacks("x", "y"), F.col("y_whole") - lacks("y", "x"))
    reach = least / (1 + least) * (F.col("x_whole") + F.col("y_whole")) - 1e-9
    pairs = left.join(
        right,
        (F.col("key") == F.col("y_key")) & (F.col("x_class") != F.col("y_class"))
        & ((F.col("y_class") == F.col("main")) | (F.col("x") < F.col("y")))
        & (both >= reach),
    )
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def classes_of_rows(source: DataFrame, least: float = 0.8) -> DataFrame:
    """``row`` and ``root``, the least row of its class, for frames of ``numbered``."""
    signed = stored(source.select("row", "text").mapInArrow(_signature_rows, SIGNATURE), "signatures")
    # Texts of equal words: the least row stands for all of them.
    equal = stored(
        signed.where("n > 0").groupBy("c1", "c2").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("copies")), "equal"
    )
    several = equal.where("copies > 1").select("c1", "c2", "rep")
    members = stored(
        signed.where("n > 0").select("row", "c1", "c2").join(several, ["c1", "c2"], "left")
        .select("row", F.coalesce("rep", "row").alias("rep")),
        "members",
    )
    banded = (
        signed.select("row", "bands").join(members.where("row = rep").select("row"), "row", "left_semi")
        .select(F.col("row").alias("id"), F.explode("bands").alias("key"))
    )
    sizes = stored(banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    shared = stored(banded.join(sizes, "key"), "shared")
    popular = stored(shared.groupBy("id").agg(F.sum("size").alias("near")), "popular")
    centers = stored(
        shared.select("key", "id").join(popular, "id").groupBy("key")
        .agg(F.max_by("id", "near").alias("center"), F.max("near").alias("near")),
        "centers",
    )
    buckets = stored(shared.select("key", "id").join(centers, "key"), "buckets")
    texts = stored(source.select("row", "text").join(popular.select(F.col("id").alias("row")), "row", "left_semi"), "texts")
    # One candidate for each text: the most popular center of its buckets.
    first = stored(
        buckets.where("id <> center").groupBy("id").agg(F.max_by("center", "near").alias("a"))
        .select("a", F.col("id").alias("b")),
        "first",
    )
    links = stored(_verified(first, texts, least), "links")
    classes = components(links)
    seen = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    untried = _open_pairs(buckets, texts, classes, least).join(seen, ["a", "b"], "left_anti")
    rest = stored(_agreeing(untried, signed, least), "rest")
    more = stored(_verified(rest, texts, least), "more-links")
    if more.take(1):
        classes = components(links.unionByName(more))
    rooted = _in_class(members.withColumnRenamed("rep", "id"), "id", classes)
    return rooted.select("row", F.col("id_class").alias("root")).unionByName(
        signed.where("n = 0").select("row", F.col("row").alias("root"))
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """``doc_id``, ``class_id`` (the least id of its class) and ``keeps`` (true for one row of a class).

    A class holds the texts that links of similarity ``least`` or more connect: the weighted
    Jaccard similarity of bags of five words; a text of fewer words is one shingle. Null texts
    and texts without words are each a class of their own. Equal rows are in one class, one of
    them kept. Null ids count only if a class has no other; its ``class_id`` is null then. An
    empty table gives an empty result. Other columns are not read.
    """
    ids = numbered(docs, text, [doc_id]).select("row", F.col("rest").getField(doc_id).alias("doc_id"), "text")
    found = stored(ids.drop("text").join(classes_of_rows(ids, least), "row"), "classes")
    named = stored(found.groupBy("root").agg(F.min("doc_id").alias("class_id")), "class-ids")
    return found.join(named, "root").select("doc_id", "class_id", (F.col("row") == F.col("root")).alias("keeps"))


def without_copies(docs: DataFrame, text: str = "text", least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` with one row of each class, chosen as in ``near_duplicates``."""
    source = numbered(docs, text)
    gone = stored(classes_of_rows(source, least).where("row <> root").select("row"), "copies")
    kept = source.join(gone, "row", "left_anti")
    return kept.select(*[F.col("text").alias(c) if c == text else F.col("rest").getField(c).alias(c) for c in docs.columns])
