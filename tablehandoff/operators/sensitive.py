"""Scan of texts for sensitive values; findings carry the name of a value, never the value.

The values are indexed by anchors. The anchor of a value is the rarest of its grams among all
values, a gram being a run of 16 bytes (8, 4, 2 or 1 for shorter values). One pass over the
texts looks up every gram in a filter of fixed size; around the few that pass, a piece of the
text as long as the longest value is cut out, and an equi-join on the gram brings it together
with the values it is the anchor of. What decides is whether the piece contains the value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of a gram, each the double of the next; a value has grams of the largest that fits.
GRAMS = (16, 8, 4, 2, 1)
# Slots of the filter for each size of grams; it says "maybe" more often if there are many values.
FILTER_BITS = 22
# Bytes of texts searched together; a longer text is searched alone.
SLICE_BYTES = 1 << 22

_ODD = np.uint64(0x9E3779B97F4A7C15)


def gram_codes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit code of the gram at each place of ``data``; equal grams have equal codes."""
    codes, width = data.astype(np.uint64), 1
    while width < size:
        left, right = codes[: len(codes) - width], codes[width:]
        if width < 8:
            codes = (left << np.uint64(8 * width)) | right
        else:
            codes = (left ^ (left >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + right
        width *= 2
    codes = codes * _ODD
    return (codes ^ (codes >> np.uint64(32))) * _ODD


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array without nulls, and where its entries begin and end."""
    texts = texts.cast(pa.large_binary())
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _value_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, codes = [], []
        for value in batch.column("_value").to_pylist():
            size = next(s for s in GRAMS if s <= len(value))
            sizes.append(size)
            codes.append(np.unique(gram_codes(np.frombuffer(value, dtype=np.uint8), size)).view(np.int64))
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in codes])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *codes])))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_name"), batch.column("_value"), pa.array(sizes, pa.int32()), lists],
            ["_name", "_value", "_size", "_codes"],
        )


def anchors(values: DataFrame) -> DataFrame:
    """(_name, _value, _size, _code): each value once with the gram that fewest values have."""
    kind = T.StructType([*values.schema.fields, T.StructField("_size", T.IntegerType()), T.StructField("_codes", T.ArrayType(T.LongType()))])
    grams = values.mapInArrow(_value_grams, kind)
    every = grams.select("_name", "_value", "_size", F.explode("_codes").alias("_code"))
    often = every.groupBy("_size", "_code").agg(F.count(F.lit(1)).alias("_often"))
    rarest = F.min_by("_code", F.struct("_often", "_code")).alias("_code")
    return every.join(often, ["_size", "_code"]).groupBy("_name", "_value", "_size").agg(rarest)


def gram_filter(anchored: DataFrame) -> dict[int, bytes]:
    """By size of grams, a bit for each slot that an anchor falls into: 512 KB at most."""
    slot = F.shiftrightunsigned("_code", 64 - FILTER_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    words = (
        anchored.select("_size", F.shiftright(slot, 6).alias("word"), bit.alias("bit"))
        .groupBy("_size", "word").agg(F.bit_or("bit").alias("bits")).toArrow()
    )
    sizes, word, bits = (words.column(c).to_numpy() for c in ("_size", "word", "bits"))
    out = {}
    for size in np.unique(sizes).tolist():
        held = np.zeros(1 << (FILTER_BITS - 6), np.int64)
        held[word[sizes == size]] = bits[sizes == size]
        out[size] = held.tobytes()
    return out


def _hits(data: np.ndarray, offsets: np.ndarray, filters: dict[int, np.ndarray]):
    """(place, size, code) of the grams that pass the filter, by place."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64))]
    end = np.repeat(offsets[1:], np.diff(offsets))
    for size, passes in filters.items():
        codes = gram_codes(data, size) if len(data) >= size else np.zeros(0, np.uint64)
        places = np.flatnonzero(passes[codes >> np.uint64(64 - FILTER_BITS)])
        places = places[places + size <= end[places]]  # a gram does not reach into the next text
        found.append((places, np.full(len(places), size, np.int32), codes[places].view(np.int64)))
    places, sizes, codes = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(places, kind="stable")
    return places[order], sizes[order], codes[order]


def _pieces(filters: dict[int, bytes], reach: int):
    """Pieces of the texts around the grams that pass, each with those grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = {s: np.unpackbits(np.frombuffer(b, dtype=np.uint8), bitorder="little").astype(bool) for s, b in filters.items()}
        for batch in batches:
            whole, bounds = _bytes(batch.column("_text"))
            low = 0
            while low < batch.num_rows:
                high = int(np.searchsorted(bounds, bounds[low] + SLICE_BYTES, side="right")) - 1
                high = min(max(high, low + 1), batch.num_rows)
                data, offsets = whole[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
                places, sizes, codes = _hits(data, offsets, bits)
                if len(places):
                    text = np.searchsorted(offsets, places, side="right") - 1
                    first = np.maximum(places - reach, offsets[text])
                    last = np.minimum(places + reach, offsets[text + 1])
                    # Overlapping pieces of a text are one piece.
                    new = np.append(True, (text[1:] != text[:-1]) | (first[1:] > last[:-1]))
                    start = np.flatnonzero(new)
                    ends = np.maximum.reduceat(last, start)
                    pieces = [data[a:b].tobytes() for a, b in zip(first[start].tolist(), ends.tolist())]
                    cuts = pa.array(np.append(start, len(places)).astype(np.int32))
                    mine = pa.array(text[start] + low)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("_row").take(mine), batch.column("_key").take(mine), pa.array(pieces, pa.binary()),
                            pa.ListArray.from_arrays(cuts, pa.array(sizes)), pa.ListArray.from_arrays(cuts, pa.array(codes)),
                        ],
                        ["_row", "_key", "_piece", "_sizes", "_codes"],
                    )
                low = high

    return run


def sensitive_scan(texts: DataFrame, key: str, content: str, values: DataFrame, name: str, value: str) -> DataFrame:
    """(key, name) for every non-empty value that occurs in a text, each once for each text.

    One pass over the texts for any number of values. Only pieces around grams that some value
    has as its anchor are shuffled; overlapping pieces of a text are one, so a text is shuffled
    once for each distinct anchor in it at most. The values come from their table at run time:
    they are written to no table and appear in no plan, log or result. The driver gets the
    filter, whose size does not depend on the number of values, and the length of the longest
    value. Null texts and null or empty values find nothing.
    """
    as_bytes = F.col(value).cast("string").cast("binary")
    wanted = values.select(F.col(name).alias("_name"), as_bytes.alias("_value")).where(F.length(as_bytes) > 0).distinct()
    anchored = anchors(wanted)
    reach = wanted.agg(F.max(F.length("_value"))).first()[0] or 0
    filters = gram_filter(anchored) if reach else {}
    plain = texts.select(
        F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"),
        F.col(content).cast("string").cast("binary").alias("_text"),
    ).where(F.col("_text").isNotNull())
    found = (("_piece", T.BinaryType()), ("_sizes", T.ArrayType(T.IntegerType())), ("_codes", T.ArrayType(T.LongType())))
    kind = T.StructType([*plain.schema.fields[:2], *[T.StructField(*f) for f in found]])
    pieces = plain.mapInArrow(_pieces(filters, reach), kind)
    grams = pieces.select(
        "_row", "_key", "_piece", F.explode(F.array_distinct(F.arrays_zip("_sizes", "_codes"))).alias("_gram")
    ).select("_row", "_key", "_piece", F.col("_gram._sizes").alias("_size"), F.col("_gram._codes").alias("_code"))
    found = grams.join(anchored, ["_size", "_code"]).where(F.contains("_piece", F.col("_value")))
    return found.select("_row", F.col("_key").alias(key), F.col("_name").alias(name)).dropDuplicates(["_row", name]).drop("_row")
