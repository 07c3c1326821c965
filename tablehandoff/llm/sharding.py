"""Shards of near equal bytes: sampled splitters, range partitions, exact boundaries.

Rows are ordered by the checksum of their text (equal texts lie side by side), then by a hash
of their id. A sample drawn with chances in proportion to size gives quantiles of that order;
they cut the rows into ranges of about equal bytes. Ranges that turn out overfull, because
the sample was unlucky or many rows share one place in the order, are subdivided by a hash of
the row. The exact bytes of the ranges then give each row the number of bytes before it, and
that number its shard: a shard misses its share by one row at most, whatever the sample.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehandoff.llm.frames import col, stored

# Sampled rows for each range, and rows a range is meant to have.
SAMPLES = 64
RANGE_ROWS = 200_000
# Most ranges that one table of splitters holds; with more rows the ranges grow instead.
MAX_RANGES = 20_000
_LOW31 = (1 << 31) - 1


def place(checksum: Column, id: Column) -> Column:
    """Where a row stands: its checksum above 31 bits of a hash of its id."""
    return F.shiftleft(checksum, 31).bitwiseOR(F.xxhash64(id).bitwiseAND(F.lit(_LOW31)))


def splitters(rows: DataFrame, total: int, ranges: int) -> list[int]:
    """At most ``ranges - 1`` quantiles of ``place``, from a sample weighted by ``size``.

    A row is drawn if a hash of it, taken as a fraction, is below its share of the bytes times
    the wanted sample, so the draw does not depend on how the rows are partitioned.
    """
    chance = (F.xxhash64("place", "row", F.lit("draw")).bitwiseAND(F.lit((1 << 53) - 1))) / F.lit(float(1 << 53))
    drawn = rows.where(chance < F.col("size") * F.lit(ranges * SAMPLES / max(total, 1)))
    marks = [i / ranges for i in range(1, ranges)]
    if not marks:
        return []
    found = drawn.agg(F.percentile_approx("place", marks, 10 * ranges).alias("marks")).first().marks
    return sorted(set(found or []))


def assign(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 24) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``size`` is the number of UTF-8 bytes of the text and 8; the law is ``bytes``: a shard
    takes the rows whose middle byte lies in its share of all bytes, so sizes differ by at most
    one row at either end. ``slot`` counts from 0 in each shard. ``grown_shard`` is null.

    A null text counts as empty, a null id is an id like others. Rows with equal id and text
    take neighbouring slots of their range in any order. With fewer rows than shards some
    shards stay empty; an empty table gives an empty result. Other columns are not read. Each
    row is numbered by its place in the scan, so ``docs`` must be read from a table.
    """
    whole = F.coalesce(col(text).cast("string"), F.lit(""))
    rows = docs.select(
        col(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        (F.octet_length(whole).cast("long") + 8).alias("size"),
        F.crc32(whole).alias("text_crc32"),
    ).withColumn("place", place(F.col("text_crc32"), F.col("doc_id")))
    rows = stored(rows, "sizes")
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = int(min(MAX_RANGES, max(4 * shards, -(-n // RANGE_ROWS))))
    marks = np.array(splitters(rows, total, ranges), dtype=np.int64)

    @F.pandas_udf("int")
    def range_of(places: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(marks, places.to_numpy(), side="right").astype(np.int32))

    ranged = rows.withColumn("range", range_of("place"))
    # Overfull ranges are cut by a hash of the row into parts of the size of a range.
    share = max(1, -(-total // ranges))
    counted = ranged.groupBy("range").agg(F.sum("size").alias("bytes"))
    over = counted.where(F.col("bytes") > 2 * share).select(
        "range", F.ceil(F.col("bytes") / share).cast("long").alias("parts")
    )
    parts = {r.range: r.parts for r in over.collect()}  # at most one entry for each range
    splits = np.ones(ranges, dtype=np.int64)
    for r, p in parts.items():
        splits[r] = p

    @F.pandas_udf("long")
    def part_of(where: pd.Series, hashed: pd.Series) -> pd.Series:
        return pd.Series(hashed.to_numpy().view(np.uint64) % splits[where.to_numpy()].astype(np.uint64)).astype("int64")

    split = ranged.withColumn("part", part_of("range", F.xxhash64("row", F.lit("part"))))
    pieces = split.groupBy("range", "part").agg(F.sum("size").alias("bytes"))
    before = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        pieces.select("range", "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start")), "starts"
    )
    inside = Window.partitionBy("range", "part").orderBy("place", "doc_id", "row")
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    placed = split.withColumn("inner", F.coalesce(running, F.lit(0))).join(starts, ["range", "part"])
    middle = 2 * (F.col("start") + F.col("inner")) + F.col("size")  # twice the middle byte
    shard = F.least(F.floor(middle * F.lit(shards) / F.lit(2 * max(total, 1))), F.lit(shards - 1)).cast("int")
    placed = placed.withColumn("shard", shard).withColumn(
        "nth", F.row_number().over(Window.partitionBy("range", "part", "shard").orderBy("place", "doc_id", "row"))
    )
    counts = placed.groupBy("range", "part", "shard").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        counts.select("range", "part", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")), "offsets"
    )
    return placed.join(offsets, ["range", "part", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("nth") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
