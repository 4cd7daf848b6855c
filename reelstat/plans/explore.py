"""Exploring a table: limits, samples, filter values, time grains and shifts, drill-down, rules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.functions.times import relative_range, time_grain
from reelstat.operators.joins import having_keys, match
from reelstat.sinks.tables import replace_table

# Row limits by use.
CHART_ROWS = 50_000
MAX_ROWS = 100_000
DISPLAY_ROWS = 10_000
EDITOR_ROWS = 1_000
SAMPLE_ROWS = 1_000
FILTER_SEARCH_ROWS = 10_000
FILTER_ROWS = 1_000


def allowed(requested: int, most: int = MAX_ROWS) -> int:
    """A number of rows that a caller may ask for; a larger one is an error, not a shorter result."""
    if not 0 <= requested <= most:
        raise ValueError(f"{requested} rows asked for; at most {most} are given")
    return requested


def limited(df: DataFrame, requested: int) -> DataFrame:
    """A query's rows up to the number asked for: ``CHART_ROWS`` for a chart, ``DISPLAY_ROWS`` for
    a table on the screen, ``MAX_ROWS`` at most.

    Meant to be collected, which reads as few partitions as give the rows.
    """
    return df.limit(allowed(requested))


def sample_rows(df: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """Some rows to look at; the first found, not a random sample."""
    return df.limit(n)


def filter_values(
    df: DataFrame, column: str, requested: int, search: str | None = None
) -> DataFrame:
    """Distinct values to choose a filter from, in order: the first ``requested``.

    A list that is opened takes ``FILTER_ROWS``. With ``search`` only values that contain the text
    are listed, up to ``FILTER_SEARCH_ROWS``.
    """
    values = df.select(column).distinct()
    if search is not None:
        values = values.filter(F.contains(F.lower(F.col(column).cast("string")), F.lit(search.lower())))
    return values.orderBy(column).limit(allowed(requested, FILTER_SEARCH_ROWS))


def relative_time_filter(
    df: DataFrame,
    column: str,
    as_of: datetime,
    days: int,
    start: str = "today",
    end: str = "today",
) -> DataFrame:
    """Rows of the last ``days`` days, counted from midnight (``today``) or the moment (``now``)."""
    return df.filter(relative_range(F.col(column), as_of, days, start, end))


def by_time_grain(
    df: DataFrame, column: str, grain: str, metrics: list[Column], out: str = "bucket"
) -> DataFrame:
    """Metrics per time bucket."""
    return df.groupBy(time_grain(F.col(column), grain).alias(out)).agg(*metrics)


def time_shift(
    series: DataFrame, time: str, metric: str, shift: Column, keys: list[str] | None = None
) -> DataFrame:
    """Adds ``prev``: the metric of the bucket at ``shift``, or NULL if that one has no rows.

    ``series`` has one row per keys and bucket. ``shift`` gives, from a bucket, the earlier one to
    compare with. The join is on the bucket itself, so gaps in the series do no harm.
    """
    keys = keys or []
    past = series.select(
        *[F.col(key).alias(f"_{key}") for key in keys],
        F.col(time).alias("_then"),
        F.col(metric).alias("prev"),
    )
    shifted = series.withColumn("_earlier", shift)
    condition = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    # Null-safe here too: a plain comparison would filter NULLs on one side only, and the series
    # would be computed twice instead of its shuffle being used for both sides.
    condition.append(F.col("_earlier").eqNullSafe(F.col("_then")))
    prev = F.when(F.col("_earlier").isNotNull(), F.col("prev"))
    return shifted.join(past, condition, "left").select(*series.columns, prev.alias("prev"))


def ctas_limited(query: DataFrame, table: str, requested: int) -> None:
    """Saves a query's first rows as a table: ``EDITOR_ROWS`` from an editor, ``MAX_ROWS`` at most.

    Every task stops at that many rows of its own, and one task writes those that are kept; none
    pass the driver.
    """
    replace_table(query.limit(allowed(requested)), table)


def drill_to_detail(detail: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """The detail rows behind chosen cells of an aggregate over ``keys``."""
    return having_keys(detail, cells, keys)


def parameterised_sql(
    spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame
) -> DataFrame:
    """SQL with named parameters (``:name``) over the given frames (``{name}``)."""
    return spark.sql(text, args=args or {}, **frames)


def row_level_filter(
    df: DataFrame, rules: DataFrame, role: str, columns: dict[str, str]
) -> DataFrame:
    """The rows a role may see.

    ``rules`` has a ``role`` column and the permitted values; ``columns`` tells, by column of
    ``df``, which rule column applies to it. A role without a rule sees nothing, and nobody sees
    rows that have no value in such a column.
    """
    allowed = rules.filter(F.col("role") == role).select(
        *[F.col(rule).alias(column) for column, rule in columns.items()]
    )
    return match(df, allowed.dropna(), list(columns), "left_semi")
