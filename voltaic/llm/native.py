"""Column helpers for the operators that use Spark expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
