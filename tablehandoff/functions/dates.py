"""Dates in file names and exported columns."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Oracle date mask elements and their Spark pattern letters.
ORACLE_MASK = {
    "YYYY": "yyyy",
    "YY": "yy",
    "MM": "MM",
    "DD": "dd",
    "HH24": "HH",
    "HH12": "hh",
    "MI": "mm",
    "SS": "ss",
}

UTC_STAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"

_ELEMENT = re.compile("|".join(sorted(ORACLE_MASK, key=len, reverse=True)) + "|[A-Z]+|[^A-Z]+")


def spark_pattern(mask: str) -> str:
    """Spark date pattern for an Oracle mask; unknown elements are an error."""
    parts = []
    for piece in _ELEMENT.findall(mask.upper()):
        if piece in ORACLE_MASK:
            parts.append(ORACLE_MASK[piece])
        elif piece.isalpha():
            raise ValueError(f"date mask element '{piece}' is not supported")
        else:
            parts.append(piece)
    return "".join(parts)


def format_date(c: Column, mask: str = "YYYY-MM-DD") -> Column:
    return F.date_format(c, spark_pattern(mask))


def utc_stamp(c: Column) -> Column:
    return F.date_format(c, UTC_STAMP)


def resolve_file_name(pattern: str, run_date: date) -> str:
    return pattern.replace("{yyyymmdd}", run_date.strftime("%Y%m%d"))
