"""Landing documents to curated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.casts import count_of, instant_of
from reelstat.operators.nested import explode_videos


def curate(docs: DataFrame, wide: bool = False) -> DataFrame:
    """One typed row per video, with the year and month it was published in (session zone).

    Columns are in the order of the curated table, whose inserts go by position.
    """
    published = instant_of(F.col("video.publishedAt"))
    return explode_videos(docs).select(
        "channelName",
        count_of(F.col("subscribers"), wide).alias("subscribers"),
        count_of(F.col("totalVideos"), wide).alias("totalVideos"),
        F.col("video.title").alias("video_title"),
        published.alias("publishedAt"),
        count_of(F.col("video.viewCount"), wide).alias("viewCount"),
        F.year(published).alias("year"),
        F.month(published).alias("month"),
    )
