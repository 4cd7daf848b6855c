"""Casts of API text. A bad value becomes NULL; it never fails the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_of(column: Column, wide: bool = False) -> Column:
    """Whole number in a string. A fraction is cut off; other text, or a value out of range, gives
    NULL."""
    kind = "bigint" if wide else "int"
    whole = F.regexp_extract(column, r"^\s*([+-]?\d*)\.\d*\s*$", 1)
    cut = F.when(column.rlike(r"^\s*[+-]?\d+\.\d*\s*$"), whole.try_cast(kind))
    none_before = F.when(column.rlike(r"^\s*[+-]?\.\d+\s*$"), F.lit(0).cast(kind))
    return F.coalesce(column.try_cast(kind), cut, none_before)


def instant_of(column: Column) -> Column:
    """ISO-8601 text as a timestamp."""
    return column.try_cast("timestamp")


def or_default(column: Column, default: str = "0") -> Column:
    """A missing field replaced by a constant."""
    return F.coalesce(column, F.lit(default))
