"""Time expressions: month keys, rolling and relative ranges, grains."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: the format the API writes instants in.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def instant(as_of: datetime) -> Column:
    """A point in time as a constant. Without a zone it means the session zone.

    The constant has no zone of its own then, so comparing it casts the constant and never the
    column: the comparison still reaches the scan for columns of either timestamp type.
    """
    kind = "timestamp_ntz" if as_of.tzinfo is None else "timestamp"
    return F.lit(as_of.isoformat(sep=" ")).cast(kind)


def iso_text(column: Column) -> Column:
    """A timestamp as API text (session zone UTC)."""
    return F.date_format(column, ISO_FORMAT)


def month_key(iso: Column) -> Column:
    """``yyyy-MM`` of an ISO string, taken as its first seven characters."""
    return F.substring(iso, 1, 7)


def utc_text(column: Column) -> Column:
    """A point in time as API text, whatever the session zone is now."""
    session = SparkSession.active()
    zone = session.conf.get("spark.sql.session.timeZone")
    return iso_text(F.to_utc_timestamp(column.cast("timestamp"), F.lit(zone)))


def published_since(column: Column, as_of: datetime, days: int = 365, iso: bool = False) -> Column:
    """True for the ``days`` days up to ``as_of``; the border instant is kept.

    ``as_of`` is a parameter so that a rerun gives the same rows. With ``iso`` the column holds
    API text, which is in UTC, and is compared as text, which needs no parsing.
    """
    cutoff = instant(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    return column >= (utc_text(cutoff) if iso else cutoff)


def anchored(as_of: datetime, anchor: str) -> datetime:
    """``today`` is the midnight before ``as_of``, ``now`` is ``as_of`` itself."""
    if anchor == "now":
        return as_of
    if anchor == "today":
        return as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    raise ValueError(f"anchor must be 'today' or 'now', not {anchor!r}")


def relative_range(
    column: Column, as_of: datetime, days: int, start: str = "today", end: str = "today"
) -> Column:
    """True for the last ``days`` days, each end anchored on its own."""
    first = instant(anchored(as_of, start)) - F.expr(f"INTERVAL {int(days)} DAYS")
    return (column >= first) & (column < instant(anchored(as_of, end)))


UNITS = ["second", "minute", "hour", "day", "week", "month", "quarter", "year"]
MONTHS = {"month": 1, "quarter": 3, "year": 12}


def time_grain(column: Column, grain: str) -> Column:
    """Start of the bucket a timestamp falls in; NULL for NULL.

    ``grain`` is one of ``UNITS`` or a number of them, such as ``2 seconds`` or ``3 months``.
    Numbered buckets are counted from the start of 1970.
    """
    number, _, unit = grain.strip().lower().rpartition(" ")
    unit = unit.removesuffix("s")
    if unit not in UNITS or number and not (number.strip().isdigit() and int(number)):
        raise ValueError(f"unknown grain {grain!r}; units are {', '.join(UNITS)}")
    if not number:
        return F.date_trunc(unit, column)
    if unit in MONTHS:
        step = int(number) * MONTHS[unit]
        month = F.date_trunc("month", column)
        passed = F.pmod((F.year(column) - 1970) * 12 + F.month(column) - 1, F.lit(step))
        return month - F.make_ym_interval(F.lit(0), passed)
    # A window drops rows without a time, so they get one that is taken away again.
    known = F.coalesce(column, F.expr("TIMESTAMP_NTZ'1970-01-01'"))
    return F.when(column.isNotNull(), F.window(known, f"{int(number)} {unit}")["start"])
