"""Aggregates kept up to date batch by batch.

A state has a row for each key with values that merge: sums and largest ones. Every row of a new batch
makes such values, which are merged with the stored ones in one aggregation, reduced by each task ahead
of its only shuffle; the curated rows of earlier batches are not read again. Every row of a state tells
the last batch it covers; the state is replaced as a whole, so it moves on with its rows or not at all,
and a repeated update adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.plans import reports
from reelstat.sinks.batches import batches_of
from reelstat.sinks.tables import replace_table

#: Names the last batch that a state covers.
THROUGH = "through"


@dataclass(frozen=True)
class State:
    """Keys, and for each value what a row adds to it and how they merge."""

    name: str
    keys: tuple[str, ...]
    values: dict[str, tuple[Column, Callable[[str], Column]]]
    #: Gives the rows that values are made of.
    rows: Callable[[DataFrame], DataFrame] = lambda curated: curated

    def of(self, curated: DataFrame) -> DataFrame:
        """Keys and values of each row, to be merged."""
        made = [value.alias(name) for name, (value, _) in self.values.items()]
        return self.rows(curated).select(*self.keys, *made)

    def merged(self, *parts: DataFrame) -> DataFrame:
        """One row for each key, out of stored rows and new ones."""
        names = [*self.keys, *self.values]
        union = parts[0].select(*names)
        for part in parts[1:]:
            union = union.unionAll(part.select(*names))
        merges = [merge(name).alias(name) for name, (_, merge) in self.values.items()]
        return union.groupBy(*self.keys).agg(*merges)


def months() -> State:
    """Titled rows and the largest audience by channel and month."""
    return State("months", ("channelName", "year", "month"), {
        "monthlyVideosPublished": (F.col("video_title").isNotNull().cast("bigint"), F.sum),
        "subscribers": (F.col("subscribers"), F.max),
    })


def titles() -> State:
    """The largest view count by channel and title."""
    return State("titles", ("channelName", "video_title"), {"viewCount": (F.col("viewCount"), F.max)})


def values_of(*columns: str) -> State:
    """How often each value of some columns occurs, as text, to choose filters from."""
    def rows(curated: DataFrame) -> DataFrame:
        entries = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]
        return curated.select(F.inline(F.array(*entries)))

    return State("values", ("field", "value"), {"n": (F.lit(1).cast("bigint"), F.sum)}, rows)


def advance(spark: SparkSession, state: State, table: str, last: int, prefix: str = "") -> str:
    """Merges the batches of ``table`` up to ``last`` that the state does not cover yet; returns the
    name of the state's table. Rows appended from elsewhere belong to no such batch."""
    name = f"{prefix}state_{state.name}"
    known = spark.table(name) if spark.catalog.tableExists(name) else None
    through = known.agg(F.max(THROUGH)).first()[0] if known is not None else None
    begin = 0 if through is None else through + 1
    if known is not None and begin > last:
        return name
    batches = spark.table(batches_of(table)).filter(F.col("batch").between(begin, last))
    new = state.of(batches)
    rows = state.merged(known, new) if known is not None else state.merged(new)
    replace_table(rows.withColumn(THROUGH, F.lit(last).cast("bigint")), name)
    return name


def update_reports(spark: SparkSession, table: str, last: int, prefix: str = "") -> dict[str, str]:
    """The four report tables, from states that first take up the batches to ``last``."""
    by_month, by_title = (
        spark.table(advance(spark, state, table, last, prefix)).drop(THROUGH) for state in (months(), titles())
    )
    frames = {
        "channel_subscribers": reports.channel_subscribers(by_month),
        "video_count": by_month.groupBy("channelName").agg(
            F.sum("monthlyVideosPublished").alias("totalVideosPublished")
        ),
        "video_trend": by_month.drop("subscribers"),
        "most_viewed_videos": by_title.withColumnRenamed("viewCount", "totalViews"),
    }
    for report, frame in frames.items():
        replace_table(frame, f"{prefix}{report}")
    return {report: f"{prefix}{report}" for report in frames}


def choices(
    dictionary: DataFrame, column: str, requested: int, prefix: str | None = None
) -> DataFrame:
    """Values of a column and how often they occur, in order, the first ``requested``; with
    ``prefix`` only those that begin with it. Reads the dictionary, not the rows it was made of."""
    found = dictionary.filter((F.col("field") == column) & F.col("value").isNotNull())
    if prefix is not None:
        found = found.filter(F.startswith("value", F.lit(prefix)))
    return found.orderBy("value").limit(requested).select("value", "n")
