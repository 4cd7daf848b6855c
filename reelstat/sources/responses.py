"""Raw API responses, kept as JSON text in a column, to flat rows.

Each function takes the other columns of its input along, so a channel id or page number that
was stored next to the response stays with the rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat import schemas
from reelstat.functions.casts import or_default
from reelstat.functions.times import published_since


def _parsed(df: DataFrame, response: str, schema: str) -> tuple[DataFrame, list[str]]:
    kept = [name for name in df.columns if name != response]
    return df.select(*kept, F.from_json(response, schema).alias("_response")), kept


def channels_from_responses(df: DataFrame, response: str = "response") -> DataFrame:
    """One row of channel statistics per response, read from its first item."""
    parsed, kept = _parsed(df, response, schemas.CHANNEL_RESPONSE)
    item = F.get("_response.items", F.lit(0))
    return parsed.select(
        *kept,
        item["snippet"]["title"].alias("channelName"),
        item["statistics"]["subscriberCount"].alias("subscribers"),
        item["statistics"]["viewCount"].alias("views"),
        item["statistics"]["videoCount"].alias("totalVideos"),
        item["contentDetails"]["relatedPlaylists"]["uploads"].alias("playlistId"),
    )


def ids_from_playlist_pages(
    df: DataFrame, response: str = "response", with_token: bool = False
) -> DataFrame:
    """The ids each page lists, in page order, and whether another page follows; ``with_token`` adds
    the token of that page."""
    parsed, kept = _parsed(df, response, schemas.PLAYLIST_RESPONSE)
    return parsed.select(
        *kept,
        F.col("_response.items.contentDetails.videoId").alias("videoIds"),
        F.col("_response.nextPageToken").isNotNull().alias("hasNext"),
        *([F.col("_response.nextPageToken").alias("nextPageToken")] if with_token else []),
    )


def videos_from_responses(
    df: DataFrame, as_of: datetime | None = None, days: int = 365, response: str = "response"
) -> DataFrame:
    """One row per listed video.

    A count the API left out is NULL and a missing duration is ``'0'``. With ``as_of``, only
    videos of the ``days`` days before it are kept.
    """
    parsed, kept = _parsed(df, response, schemas.VIDEO_RESPONSE)
    item = F.col("_item")
    rows = parsed.select(*kept, F.explode("_response.items").alias("_item")).select(
        *kept,
        item["id"].alias("videoId"),
        *[item["snippet"][f] for f in ["channelTitle", "title", "description", "publishedAt"]],
        *[item["statistics"][f] for f in ["viewCount", "likeCount", "commentCount"]],
        or_default(item["contentDetails"]["duration"]).alias("duration"),
        item["contentDetails"]["definition"].alias("definition"),
    ).toDF(*kept, *schemas.VIDEO_FIELDS)
    if as_of is None:
        return rows
    return rows.filter(published_since(F.col("publishedAt"), as_of, days, iso=True))
