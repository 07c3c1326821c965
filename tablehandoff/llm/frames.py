"""Input frames of the operators: quoted names, row numbers, written intermediate tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehandoff.session import work_folder


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(df: DataFrame, text: str, others: Sequence[str] | None = None) -> DataFrame:
    """``row`` (a number for each row), ``text`` and the other columns as one struct ``rest``.

    Packing the other columns keeps their names from clashing with those of an operator. The
    number is the place of the row in the scan: ``df`` must be read from a table, so that a
    task that is run again gives its rows the same numbers.
    """
    names = [c for c in (df.columns if others is None else others) if c != text]
    rest = F.struct(*[col(c).alias(c) for c in names]) if names else F.struct(F.lit(0).alias("_"))
    return df.select(
        F.monotonically_increasing_id().alias("row"), col(text).cast("string").alias("text"),
        rest.alias("rest"),
    )


def unpacked(df: DataFrame, names: Iterable[str], text: str, results: Sequence[str]) -> DataFrame:
    """The columns ``names`` out of ``rest`` and ``text``, then ``results``, which win where
    names clash."""
    taken = {r.lower() for r in results}
    kept = [
        F.col("text").alias(c) if c == text else F.col("rest").getField(c).alias(c)
        for c in names if c.lower() not in taken
    ]
    return df.select(*kept, *results)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again: cuts the lineage, and
    makes a plain input of what was an aggregate, so that a skewed join against it is split."""
    folder = work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
