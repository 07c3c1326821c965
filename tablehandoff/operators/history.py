"""Version history: capped lists, lookups, validity intervals and latest rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehandoff.scale import GROUP_LIMIT, next_in_group, running_total

HISTORY_CAP = 10  # fixed value: versions kept per key
FOUND, OUT_OF_RANGE, NO_HISTORY, NO_ID = "found", "out of range", "no history", "no id"
# Up to this rank the optimizer cuts every map partition to the top rows before the
# shuffle, which keeps a hot key small; see spark.sql.optimizer.windowGroupLimitThreshold.
TOP_LIMIT = 1_000


def _newest_first(order_by: Sequence[str]) -> list[Column]:
    return [F.col(c).desc() for c in order_by]


def capped_history(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], cap: int = HISTORY_CAP
) -> DataFrame:
    """The newest ``cap`` versions per key with ``version`` 0 for the newest.

    The rank limit is pushed below the shuffle: a map task sends at most ``cap`` rows per
    key, whatever the size of the key. Caps too high for that count in ordered runs.
    """
    if cap > TOP_LIMIT:
        ranked = running_total(df, keys, _newest_first(order_by), F.lit(1), "version")
        return ranked.where(F.col("version") < cap)
    w = Window.partitionBy(*keys).orderBy(*_newest_first(order_by))
    ranked = df.withColumn("version", F.row_number().over(w))
    return ranked.where(F.col("version") <= cap).withColumn(
        "version", (F.col("version") - 1).cast("long")
    )


def version_at(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    n: int = 0,
    stored_id: str | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Every key with its n-th newest version (0 = newest) and a ``status``.

    Distinct outcomes: found, out of range (fewer versions), no history (a wanted key
    without any version), no id (the version has no stored id). Columns of the version
    are null unless found or without id.
    """
    rest = [c for c in df.columns if c not in keys]
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("versions"))
    if wanted is not None:
        sizes = wanted.select(*keys).distinct().join(sizes, list(keys), "left")
    nth = capped_history(df, keys, order_by, n + 1).where(F.col("version") == n)
    nth = nth.withColumn("_found", F.lit(True)).drop("version")
    out = sizes.join(nth, list(keys), "left")
    status = F.when(F.coalesce("versions", F.lit(0)) == 0, NO_HISTORY).when(
        F.col("_found").isNull(), OUT_OF_RANGE
    )
    if stored_id is not None:
        status = status.when(F.coalesce(F.col(stored_id), F.lit("")) == "", NO_ID)
    return out.select(
        *keys,
        F.coalesce("versions", F.lit(0)).alias("versions"),
        status.otherwise(FOUND).alias("status"),
        *rest,
    )


def version_intervals(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    valid_from: str,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Adds ``valid_to`` (start of the next version) and ``archived`` (there is one).

    The next version is looked up inside ordered runs, so a hot key is spread over tasks.
    """
    marked = df.withColumn("_at", F.struct(F.col(valid_from).alias("ts")))
    out = next_in_group(marked, keys, order_by, "_at", "_next", limit)
    return out.select(
        *df.columns,
        F.col("_next.ts").alias("valid_to"),
        F.col("_next").isNotNull().alias("archived"),
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The newest row per key.

    A rank and not an aggregate of whole rows: columns nobody reads are not scanned, and
    every map task passes on one row per key.
    """
    return _ranked_first(df, keys, _newest_first(order_by))


def _ranked_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).select(*df.columns)


def patch_latest(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], column: str, value: Column
) -> DataFrame:
    """``column`` set to ``value`` in the newest row per key, other rows untouched.

    The newest rows are found by an aggregate and joined back on key and order together:
    that is unique, so a hot key does not gather in one task.
    """
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order_by)).alias("_at"))
    newest = newest.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.col(f"_at.{c}").alias(f"_k_{c}") for c in order_by],
        F.lit(True).alias("_newest"),
    )
    on = None
    for c in [*keys, *order_by]:
        same = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        on = same if on is None else on & same
    joined = df.join(newest, on, "left")
    return joined.select(
        *[
            F.when(F.col("_newest"), value).otherwise(F.col(c)).alias(c) if c == column
            else F.col(c)
            for c in df.columns
        ]
    )


def history_counts(
    keys_table: DataFrame, history: DataFrame, keys: Sequence[str], name: str = "versions"
) -> DataFrame:
    """Versions per known key, zero for keys without history."""
    counts = history.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return (
        keys_table.select(*keys)
        .join(counts, list(keys), "left")
        .withColumn(name, F.coalesce(name, F.lit(0)))
    )


def dedupe_first_seen(
    df: DataFrame, keys: Sequence[str], seq: Sequence[str], ordered: bool = True
) -> DataFrame:
    """The first row per key, in order of first appearance."""
    out = _ranked_first(df, keys, [F.col(c) for c in seq])
    return out.orderBy(*seq) if ordered else out
