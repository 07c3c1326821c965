"""Snapshots stored by key, so that two of them are compared without moving rows.

A snapshot is a table with one row for each key, dealt into buckets by the key and sorted in
them. Two snapshots with the same number of buckets meet bucket by bucket in a merge join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The key as one text that is never null, and the digest of all fields.
KEY, DIGEST = "_key", "_digest"
BUCKETS = 32


def as_text(columns: Sequence[Column]) -> Column:
    """The columns as one text; null, an empty text and a missing field are told apart."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_snapshot(
    df: DataFrame, name: str, path: str, keys: Sequence[str], fields: Mapping[str, Column], buckets: int = BUCKETS
) -> DataFrame:
    """Stores (keys, fields) of ``df`` as the table ``name`` at ``path``; returns the table.

    Every field is stored as JSON text with an empty object for null. Of rows with the same
    key the one with the largest digest stays; map tasks pass on one row per key, so copies of
    a key do not gather in a task.
    """
    taken = [F.col(f"`{k}`") for k in keys]
    texts = {n: F.to_json(F.struct(c.alias("v"))) for n, c in fields.items()}
    rows = df.select(as_text(taken).alias(KEY), *taken, *[c.alias(f"_f_{n}") for n, c in texts.items()])
    rows = rows.withColumn(DIGEST, F.sha2(as_text([F.col(f"`_f_{n}`") for n in fields]), 256))
    newest = F.row_number().over(Window.partitionBy(KEY).orderBy(F.desc(DIGEST)))
    single = rows.withColumn("_rank", newest).where(F.col("_rank") == 1).drop("_rank")
    # One task writes a bucket, so that it is one sorted file.
    dealt = single.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY)
    dealt.option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def open_snapshot(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """A snapshot stored by another session, under ``name`` in this one."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def field_names(snapshot: DataFrame) -> list[str]:
    return [c.removeprefix("_f_") for c in snapshot.columns if c.startswith("_f_")]


def _matched(old: DataFrame, new: DataFrame) -> DataFrame:
    """Keys whose rows differ, with the rows of both snapshots: ``o`` and ``n``.

    The key is one text without nulls, so a plain equality compares null keys too.
    """
    o, n = old.alias("o"), new.alias("n")
    joined = o.join(n, F.col(f"o.{KEY}") == F.col(f"n.{KEY}"), "full_outer")
    return joined.where(~F.col(f"o.{DIGEST}").eqNullSafe(F.col(f"n.{DIGEST}")))


def _keys(keys: Sequence[str]) -> list[Column]:
    there = F.col(f"n.{KEY}").isNotNull()
    return [F.when(there, F.col(f"n.`{k}`")).otherwise(F.col(f"o.`{k}`")).alias(k) for k in keys]


def compare_snapshots(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, change): added, removed or modified; unchanged keys are left out."""
    change = F.when(F.col(f"o.{KEY}").isNull(), "added").when(F.col(f"n.{KEY}").isNull(), "removed").otherwise("modified")
    return _matched(old, new).select(*_keys(keys), change.alias("change"))


def compare_fields(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, field, old_value, new_value) of the fields that differ, the values as JSON text.

    Fields are laid out only for keys whose digests differ. A field or key that one snapshot
    has not counts as null there, so a null is no change against it.
    """
    names = sorted({*field_names(old), *field_names(new)})
    empty = F.lit("{}")

    def side(alias: str, df: DataFrame, name: str) -> Column:
        held = F.col(f"{alias}.`_f_{name}`") if f"_f_{name}" in df.columns else F.lit(None).cast("string")
        return F.coalesce(held, empty)

    cells = [
        F.struct(F.lit(n).alias("field"), side("o", old, n).alias("old_value"), side("n", new, n).alias("new_value"))
        for n in names
    ]
    differing = F.filter(F.array(*cells), lambda c: c["old_value"] != c["new_value"])
    return _matched(old, new).select(*_keys(keys), F.inline(differing))
