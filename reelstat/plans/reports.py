"""Reports over curated rows.

All of them are plain aggregates: each task reduces its rows to one per group before the shuffle,
so a channel that owns a third of the rows adds no more to it than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.functions.names import derived_table
from reelstat.functions.times import month_key
from reelstat.operators.ranking import top_k, top_k_per
from reelstat.session import removed, written
from reelstat.sinks.tables import append_table, replace_table


def channel_subscribers(curated: DataFrame) -> DataFrame:
    """Largest audience seen per channel."""
    return curated.groupBy("channelName").agg(F.max("subscribers").alias("totalSubscribers"))


def video_count(curated: DataFrame) -> DataFrame:
    """Titled rows per channel. Rows ingested twice count twice."""
    return curated.groupBy("channelName").agg(F.count("video_title").alias("totalVideosPublished"))


def video_trend(curated: DataFrame) -> DataFrame:
    """Titled rows per channel and month."""
    return curated.groupBy("channelName", "year", "month").agg(
        F.count("video_title").alias("monthlyVideosPublished")
    )


def most_viewed(curated: DataFrame, ordered: bool = True) -> DataFrame:
    """Largest view count per channel and title, largest first and unknown counts last.

    Name and title settle ties; they also keep the many rows of one count from all being sorted
    in the same task.
    """
    views = curated.groupBy("channelName", "video_title").agg(
        F.max("viewCount").alias("totalViews")
    )
    if not ordered:
        return views
    return views.orderBy(F.desc_nulls_last("totalViews"), "channelName", "video_title")


def trend_by_month(rows: DataFrame, key: Column, ordered: bool = True) -> DataFrame:
    """Rows per month key over all channels; ``key`` is the column to group by."""
    counts = rows.groupBy(key.alias("publish_month")).agg(F.count("*").alias("count"))
    return counts.orderBy("publish_month") if ordered else counts


def trend_per_channel(curated: DataFrame) -> DataFrame:
    """Rows per channel and month key, counting untitled ones too."""
    key = month_key(F.col("publishedAt").cast("string")).alias("publish_month")
    return curated.groupBy("channelName", key).agg(F.count("*").alias("count"))


def top_videos_per_channel(curated: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most viewed rows of each channel, by number and not by text.

    Title and time settle ties; rows that still tie are equal.
    """
    rows = curated.select("channelName", "video_title", "viewCount", "publishedAt")
    order = [F.desc_nulls_last("viewCount"), F.col("video_title"), F.col("publishedAt")]
    return top_k_per(rows, ["channelName"], order, k)


def top_videos(curated: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most viewed rows over all channels; name, title and time settle ties."""
    rows = curated.select("channelName", "video_title", "viewCount", "publishedAt")
    ties = ["channelName", "video_title", "publishedAt"]
    return top_k(rows, [F.desc_nulls_last("viewCount"), *map(F.col, ties)], k)


def channel_report(curated: DataFrame, catalog: str = "") -> DataFrame:
    """One summary row of strings per channel, with the names of its derived tables."""
    name = F.col("channelName")
    return (
        curated.groupBy("channelName")
        .agg(F.max("subscribers").alias("_subscribers"), F.max("totalVideos").alias("_videos"))
        .select(
            name.alias("channel_name"),
            F.col("_subscribers").cast("string").alias("subscribers"),
            F.col("_videos").cast("string").alias("total_videos"),
            derived_table(name, "trend_data", catalog).alias("trend_data_table"),
            derived_table(name, "most_viewed_videos", catalog).alias("most_viewed_videos_table"),
        )
    )


def write_reports(curated: DataFrame, prefix: str = "") -> dict[str, str]:
    """Replaces the four report tables; returns their names by report.

    Rows are first reduced to one per channel and month, with the largest audience next to the
    count. Three of the reports follow from those few rows, so the curated rows are read twice
    (for months and for titles) and not four times.
    """
    months = written(
        curated.groupBy("channelName", "year", "month").agg(
            F.count("video_title").alias("monthlyVideosPublished"),
            F.max("subscribers").alias("subscribers"),
        ),
        "months",
    )
    frames = {
        "channel_subscribers": channel_subscribers(months),
        "video_count": months.groupBy("channelName").agg(
            F.sum("monthlyVideosPublished").alias("totalVideosPublished")
        ),
        "video_trend": months.drop("subscribers"),
        # Tables have no order; readers order the few rows they show.
        "most_viewed_videos": most_viewed(curated, ordered=False),
    }
    for report, frame in frames.items():
        replace_table(frame, f"{prefix}{report}")
    removed(months)
    return {report: f"{prefix}{report}" for report in frames}


def append_channel_tables(curated: DataFrame, prefix: str = "", k: int = 5) -> dict[str, str]:
    """Appends the per-channel trend, top videos and summary; returns the table names.

    Each is one table with the channel as a column, so their number does not grow with the
    channels.
    """
    frames = {
        "trend_data": trend_per_channel(curated),
        "most_viewed_videos": top_videos_per_channel(curated, k),
        "report": channel_report(curated),
    }
    for kind, frame in frames.items():
        append_table(frame, f"{prefix}{kind}")
    return {kind: f"{prefix}{kind}" for kind in frames}
