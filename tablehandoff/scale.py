"""Building blocks that keep one hot group from landing in one task.

Three situations recur in the operators:

* a per-group list or an ordered window over a group of unknown size -> ``heavy_groups``
  finds the few groups above a row limit, ``ordered_runs`` cuts those groups into ordered
  runs so that no window sees more than a run;
* a running total or a position over such a group -> ``running_total`` adds the totals of
  the earlier runs to the total inside the run;
* a position in the total order of a whole table -> ``with_position``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tablehandoff.session import checkpoint_folder

# Rows one group may bring into one task as a list or a window.
GROUP_LIMIT = 100_000
# Rows a table may have to be collected and broadcast.
BROADCAST_ROWS = 10_000

_LOCAL_BITS = (1 << 33) - 1  # low bits of monotonically_increasing_id: row in partition


def bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> list[Row] | None:
    """The rows of ``df`` if there are at most ``max_rows``, else None; fetches no more
    than ``max_rows + 1``."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys]
    )


def renamed_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_k_{k}" for k in keys})


class Heavy(NamedTuple):
    """Keys (renamed ``_k_*``) of heavy groups; ``small`` if they are few enough to broadcast."""

    keys: DataFrame
    small: bool


def broadcast_if_bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """``df`` as a broadcast side and True if it has at most ``max_rows`` rows, else itself."""
    rows = bounded(df, max_rows)
    if rows is None:
        return df, False
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), True


def heavy_groups(
    df: DataFrame,
    keys: Sequence[str],
    limit: int = GROUP_LIMIT,
    weight: Column | None = None,
) -> Heavy | None:
    """The groups above ``limit`` rows (or weight), None if there are none.

    Counting combines on the map side and reads only the key columns. There are at most
    rows / limit such groups; up to BROADCAST_ROWS of them come back as a broadcast side,
    beyond that as a checkpointed table which joins by shuffle (split by skew handling).
    """
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    found = renamed_keys(
        df.groupBy(*keys).agg(size.alias("_size")).where(F.col("_size") > limit).select(*keys),
        keys,
    )
    rows = bounded(found)
    if rows is None:
        checkpoint_folder(df.sparkSession)
        return Heavy(found.checkpoint(), False)
    if not rows:
        return None
    return Heavy(F.broadcast(df.sparkSession.createDataFrame(rows, found.schema)), True)


def split_heavy(df: DataFrame, keys: Sequence[str], heavy: Heavy) -> tuple[DataFrame, DataFrame]:
    """(rows of the other groups, rows of the heavy groups)."""
    cond = same_keys(df, heavy.keys, keys)
    return df.join(heavy.keys, cond, "left_anti"), df.join(heavy.keys, cond, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; a null key is in no table.

    Both sides are read once. The optimizer broadcasts a right side that is small by its
    measured size; otherwise skew handling splits a hot key of the left side, and of a hot key
    of the right side the first row decides.
    """
    return left.join(right.select(*keys), list(keys), "left_anti")


def ordered_runs(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    limit: int = GROUP_LIMIT,
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of groups up to ``limit`` rows, rows of the heavier groups with ``_run``).

    Inside a heavy group all rows of a run sort before those of the next run: the groups
    are range-partitioned by (keys, order) and every partition is a run. The checkpoint
    fixes the range bounds, so a lost executor cannot move a row to another run.
    """
    heavy = heavy_groups(df, keys, limit)
    if heavy is None:
        return df, None
    checkpoint_folder(df.sparkSession)
    light, hot = split_heavy(df, keys, heavy)
    hot = (
        hot.repartitionByRange(*keys, *order_by)
        .withColumn("_run", F.spark_partition_id())
        .checkpoint()
    )
    return light, hot


def _per_run(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A table with about one row per run, to be joined to the rows of the runs.

    There are hardly more rows than partitions; it is broadcast once that is checked.
    """
    return broadcast_if_bounded(renamed_keys(df, [*keys, "_run"]))[0]


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    weight: Column,
    name: str,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Adds ``name``: sum of ``weight`` over the rows of the group that sort before.

    ``order_by`` must be unique inside a group; it may hold descending columns.
    """
    light, hot = ordered_runs(df.withColumn("_w", weight.cast("long")), keys, order_by, limit)

    def before(*group: str) -> Column:
        rows = Window.unboundedPreceding, -1
        w = Window.partitionBy(*group).orderBy(*order_by).rowsBetween(*rows)
        return F.coalesce(F.sum("_w").over(w), F.lit(0))

    out = light.withColumn(name, before(*keys)).select(*df.columns, name)
    if hot is None:
        return out
    earlier = (
        Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = _per_run(
        hot.groupBy(*keys, "_run")
        .agg(F.sum("_w").alias("_total"))
        .withColumn("_start", F.sum("_total").over(earlier))
        .where(F.col("_start").isNotNull())
        .drop("_total"),
        keys,
    )
    placed = hot.withColumn(name, before(*keys, "_run"))
    placed = placed.join(starts, same_keys(placed, starts, [*keys, "_run"]), "left")
    total = F.col(name) + F.coalesce("_start", F.lit(0))
    return out.unionByName(placed.withColumn(name, total).select(*df.columns, name))


def next_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    column: str,
    name: str,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Adds ``name``: value of ``column`` in the next row of the group (null in the last).

    ``order_by`` must be unique inside a group.
    """
    light, hot = ordered_runs(df, keys, order_by, limit)

    def following(*group: str) -> Column:
        return F.lead(column).over(Window.partitionBy(*group).orderBy(*order_by))

    out = light.withColumn(name, following(*keys))
    if hot is None:
        return out
    # The last row of a run continues with the first row of the next run.
    order = F.struct(*order_by)
    heads = _per_run(
        hot.groupBy(*keys, "_run")
        .agg(F.min_by(column, order).alias("_head"), F.max(order).alias("_last"))
        .withColumn("_next_head", F.lead("_head").over(Window.partitionBy(*keys).orderBy("_run")))
        .where(F.col("_next_head").isNotNull())
        .drop("_head"),
        keys,
    )
    placed = hot.withColumn(name, following(*keys, "_run"))
    last = same_keys(placed, heads, [*keys, "_run"]) & (order == F.col("_last"))
    placed = placed.join(heads, last, "left")
    placed = placed.withColumn(name, F.coalesce(name, F.col("_next_head")))
    return out.unionByName(placed.select(*df.columns, name))


def total_order(df: DataFrame, order_by: Sequence[str]) -> list[str]:
    """``order_by`` and then every other column that can be ordered."""
    rest = [f.name for f in df.schema if f.name not in order_by and "map<" not in f.dataType.simpleString()]
    return [*order_by, *rest]


def with_position(
    df: DataFrame, order_by: Sequence[str], name: str = "position"
) -> DataFrame:
    """Adds the 0-based position of every row in the total order of the table.

    The remaining columns (maps aside, they have no order) break ties, and exact copies
    of a row are told apart by their row id, so a hot key spreads over the partitions.
    One range shuffle, no window over the table: the position inside the sorted partition
    comes from the row id, the start of a partition from the row counts of the earlier
    ones (one row per partition). The checkpoint fixes the range bounds for both uses.
    """
    checkpoint_folder(df.sparkSession)
    order = [*total_order(df, order_by), "_copy"]
    placed = (
        df.withColumn("_copy", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_BITS)))
        .checkpoint()
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_local"))
        .select(*df.columns, name)
    )
