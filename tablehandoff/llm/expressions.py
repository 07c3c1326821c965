"""Column helpers of the operators that use DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The runs of characters other than SPACES."""
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")
