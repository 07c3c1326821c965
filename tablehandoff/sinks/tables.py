"""Staging refresh, append-only history, upserts and writes that skip unchanged input."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablehandoff.operators.history import latest_per_key
from tablehandoff.scale import bounded
from tablehandoff.session import checkpoint_folder
from tablehandoff import storage
from tablehandoff.sinks import versions


def staging_name(job_name: str) -> str:
    return f"STG_{job_name.upper()}"


def refresh_staging(df: DataFrame, job_name: str, folder: str) -> DataFrame:
    """Full refresh of the job's staging table below ``folder``; returns the new content.

    The rows become a new version of the table, current from one rename on: the load may read
    the table it refreshes, a missing table is no special case, and a load that stops anywhere
    leaves the old rows or the new ones, whole. The schema is that of the load query.
    """
    return versions.replace(df, f"{folder.rstrip('/')}/{staging_name(job_name)}")


def read_staging(spark: SparkSession, job_name: str, folder: str) -> DataFrame:
    return versions.read_current(spark, f"{folder.rstrip('/')}/{staging_name(job_name)}")


def append_history(
    df: DataFrame, path: str, batch: str, partition_by: Sequence[str] = ()
) -> None:
    """Archives rows; a repeated ``batch`` replaces itself instead of adding copies.

    The folder of the batch is replaced as a whole, so partitions of the attempt before
    that have no rows any more go too.
    """
    if not batch:
        raise ValueError("a batch has a name")
    # Never the dynamic mode of the session: it would keep partitions of the attempt before.
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(storage.partition_folder(path, "batch", batch))


def upsert_latest(
    state: DataFrame, updates: DataFrame, keys: Sequence[str], seq: Sequence[str]
) -> DataFrame:
    """The last write per key, by ``seq``; every map task passes on one row per key."""
    return latest_per_key(state.unionByName(updates), keys, seq)


# Names the part of a partition that a key lies in, where a partition has several.
PART = "_part"


def write_upsert(
    path: str, updates: DataFrame, keys: Sequence[str], seq: Sequence[str], partition: str, parts: int | None = None
) -> None:
    """Merges ``updates`` into a table partitioned by ``partition`` (one of the keys).

    Only partitions the updates touch are read and rewritten; the merged rows are
    checkpointed first because they come from the files being replaced. With ``parts`` a
    partition is divided into so many parts by a hash of the key, and only the parts that hold
    a key of the updates are read and rewritten: one changed key leaves the other files of its
    partition as they are. ``read_upsert`` gives the rows of either kind of table; ``parts`` must
    stay what it was when the table was first written.
    """
    spark = updates.sparkSession
    checkpoint_folder(spark)
    columns, folders = updates.columns, [partition]
    if parts is not None:
        updates = updates.withColumn(PART, F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
        folders.append(PART)
    if storage.exists(spark, path):
        touched = updates.select(*folders).distinct()
        # With the written schema: a partition value such as "01" is not read as a number.
        current = _touched(spark.read.schema(updates.schema).parquet(path), touched, folders)
        merged = upsert_latest(current.select(*updates.columns), updates, keys, seq).checkpoint()
    else:
        merged = upsert_latest(updates.limit(0), updates, keys, seq)
    _replace_partitions(merged.select(*columns, *folders[1:]), path, *folders)


def _touched(current: DataFrame, touched: DataFrame, folders: Sequence[str]) -> DataFrame:
    """The rows in the folders that ``touched`` names; the other folders are not read."""
    def cell(name: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null"))

    folder = F.concat_ws("\0", *[cell(f) for f in folders])
    known = bounded(touched.select(folder.alias("folder")).distinct())
    if known is None:
        named = touched.withColumnsRenamed({f: f"_{f}_touched" for f in folders})
        same = [F.col(f).eqNullSafe(F.col(f"_{f}_touched")) for f in folders]
        return current.join(named, reduce(lambda a, b: a & b, same), "left_semi")
    # A condition on folder columns alone is judged once for each folder, before any file.
    return current.where(folder.isin([r.folder for r in known]) if known else F.lit(False))


def read_upsert(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The rows of a table that ``write_upsert`` keeps."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).drop(PART)


def _replace_partitions(df: DataFrame, path: str, *folders: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .parquet(path)
    )


def redeliver(
    df: DataFrame, path: str, key: str = "job_name", jobs: Sequence[str] = ()
) -> None:
    """Replaces the rows of the jobs in ``df`` only; delivering twice changes nothing.

    ``jobs`` names what is delivered: those of them without rows lose their old rows.
    """
    empty = set(jobs)
    if empty:
        delivered = df.where(F.col(key).isin(sorted(empty))).select(F.col(key).cast("string")).distinct()
        empty -= {r[0] for r in delivered.collect()}  # at most as many as were named
    _replace_partitions(df, path, key)
    for job in sorted(empty):
        storage.delete(df.sparkSession, storage.partition_folder(path, key, job))


def materialize_if_changed(df: DataFrame, fingerprint: str, path: str) -> bool:
    """Makes ``df`` the current version of the table ``path`` unless that has this fingerprint.

    Rows and fingerprint become current by the same rename, so neither is ever without the other.
    """
    now = versions.current(df.sparkSession, path)
    if now is not None and now.note == fingerprint:
        return False
    versions.replace(df, path, fingerprint)
    return True
