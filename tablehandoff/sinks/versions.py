"""Tables as versioned folders behind a pointer, so that readers see whole versions only.

A table is a folder with a subfolder for each version and one small pointer file for each
publication, numbered. The pointer with the highest number names the current version. A writer
writes its version, which nobody reads yet, and then renames a finished pointer file to the
next number. That rename is the only step that changes what a reader gets: before it all rows
are old, after it all are new, and a writer that stops anywhere leaves a whole table. The
rename does not replace a file, so of two writers that finish together one gets an error.
"""

from __future__ import annotations

import json
import re
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tablehandoff import storage

POINTER = "_pointer-{:010d}.json"
_POINTER = re.compile(r"_pointer-(\d{10})\.json")


class Pointer(NamedTuple):
    """``note`` is what the writer recorded with the version, a fingerprint for example."""

    number: int
    version: str
    note: str | None


def pointers(spark: SparkSession, table: str) -> list[int]:
    """The numbers of the publications, rising."""
    found = (_POINTER.fullmatch(name) for name in storage.file_names(spark, table))
    return sorted(int(m[1]) for m in found if m)


def read_pointer(spark: SparkSession, table: str, number: int) -> Pointer:
    held = json.loads(storage.read_text(spark, f"{table}/{POINTER.format(number)}"))
    return Pointer(number, held["version"], held["note"])


def current(spark: SparkSession, table: str) -> Pointer | None:
    """The current version of a table; null if nothing was published."""
    numbers = pointers(spark, table)
    return read_pointer(spark, table, numbers[-1]) if numbers else None


def read_current(
    spark: SparkSession, table: str, schema: StructType | None = None, fmt: str = "parquet", **options: object
) -> DataFrame:
    """The rows of the current version. They stay those of that version: a later publication
    keeps the version before it."""
    now = current(spark, table)
    if now is None:
        raise FileNotFoundError(f"no version of {table} was published")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(fmt).options(**options).load(f"{table}/{now.version}")


def write_version(df: DataFrame, table: str, fmt: str = "parquet", **options: object) -> str:
    """Writes the rows as a version that is not current yet; returns its name."""
    version = f"version-{uuid.uuid4().hex}"
    df.write.format(fmt).options(**options).save(f"{table}/{version}")
    return version


def publish(spark: SparkSession, table: str, version: str, note: str | None = None) -> Pointer:
    """Makes a written version the current one."""
    numbers = pointers(spark, table)
    number = numbers[-1] + 1 if numbers else 1
    draft = f"{table}/_draft-{uuid.uuid4().hex}"
    storage.write_text(spark, draft, json.dumps({"version": version, "note": note}))
    storage.rename(spark, draft, f"{table}/{POINTER.format(number)}")
    return Pointer(number, version, note)


def clean(spark: SparkSession, table: str, keep: int = 2) -> None:
    """Removes the versions that were current before the last ``keep`` publications.

    A version goes before its pointer, so what a stopped clean leaves is removed by the next.
    Versions that were never published are left alone: their writer may still be at work.
    """
    numbers = pointers(spark, table)
    kept = {read_pointer(spark, table, n).version for n in numbers[-keep:]}
    for number in numbers[:-keep]:
        old = read_pointer(spark, table, number)
        if old.version not in kept:
            storage.delete(spark, f"{table}/{old.version}")
        storage.delete(spark, f"{table}/{POINTER.format(number)}")


def replace(df: DataFrame, table: str, note: str | None = None) -> DataFrame:
    """Writes, publishes and cleans; returns the new rows. ``df`` may read the table itself."""
    spark = df.sparkSession
    version = write_version(df, table)
    publish(spark, table, version, note)
    clean(spark, table)
    return spark.read.schema(df.schema).parquet(f"{table}/{version}")
