"""The curated table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.functions.times import published_since


def read_curated(spark: SparkSession, table: str) -> DataFrame:
    """The curated rows by catalog name."""
    return spark.table(table)


def curated_since(curated: DataFrame, as_of: datetime, days: int = 365) -> DataFrame:
    """Curated rows of the ``days`` days up to ``as_of`` (in the session zone).

    The same condition on year and month leaves older partitions unread.
    """
    first = as_of - timedelta(days=days)
    year, month = F.col("year"), F.col("month")
    late_enough = (year > first.year) | ((year == first.year) & (month >= first.month))
    return curated.filter(late_enough & published_since(F.col("publishedAt"), as_of, days))
