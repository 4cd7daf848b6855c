"""Schemas of the three layers and of the raw API responses.

Landing counts are strings, as the API sends them; casting happens when rows are curated.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the landing document and of the tables.
CHANNEL_FIELDS = ["channelName", "subscribers", "views", "totalVideos", "playlistId"]
VIDEO_FIELDS = [
    "videoId", "channelTitle", "title", "description", "publishedAt",
    "viewCount", "likeCount", "commentCount", "duration", "definition",
]
CURATED_FIELDS = [
    "channelName", "subscribers", "totalVideos", "video_title",
    "publishedAt", "viewCount", "year", "month",
]
PARTITION_FIELDS = ["year", "month"]


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def landing(
    channel_fields: list[str] = CHANNEL_FIELDS, video_fields: list[str] = VIDEO_FIELDS
) -> T.StructType:
    """Landing document schema. Naming fewer fields makes the JSON parser skip the others."""
    return _strings(channel_fields).add("videos", T.ArrayType(_strings(video_fields)))


def landing_for_curate() -> T.StructType:
    """The part of a landing document that curated rows are made of."""
    return landing(
        ["channelName", "subscribers", "totalVideos"], ["title", "publishedAt", "viewCount"]
    )


def curated(wide: bool = False) -> T.StructType:
    """Curated row. ``wide`` holds counts beyond the INT range (2,147,483,647)."""
    number = T.LongType() if wide else T.IntegerType()
    return (
        T.StructType()
        .add("channelName", T.StringType())
        .add("subscribers", number)
        .add("totalVideos", number)
        .add("video_title", T.StringType())
        .add("publishedAt", T.TimestampType())
        .add("viewCount", number)
        .add("year", T.IntegerType())
        .add("month", T.IntegerType())
    )


# Paths of the API responses that landing fields are read from.
CHANNEL_RESPONSE = """
    items ARRAY<STRUCT<
        snippet: STRUCT<title: STRING>,
        statistics: STRUCT<subscriberCount: STRING, viewCount: STRING, videoCount: STRING>,
        contentDetails: STRUCT<relatedPlaylists: STRUCT<uploads: STRING>>>>
"""
PLAYLIST_RESPONSE = """
    items ARRAY<STRUCT<contentDetails: STRUCT<videoId: STRING>>>,
    nextPageToken STRING
"""
VIDEO_RESPONSE = """
    items ARRAY<STRUCT<
        id: STRING,
        snippet: STRUCT<
            channelTitle: STRING, title: STRING, description: STRING, publishedAt: STRING>,
        statistics: STRUCT<viewCount: STRING, likeCount: STRING, commentCount: STRING>,
        contentDetails: STRUCT<duration: STRING, definition: STRING>>>
"""
