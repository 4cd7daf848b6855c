"""File sinks. A failed write fails the job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.names import safe_name
from reelstat.session import path_exists


def write_documents(
    docs: DataFrame, path: str, by_channel: bool = False, compression: str = "none"
) -> None:
    """Lands documents as JSON lines, in new files on every call.

    New names matter: an incremental reader tells files by their path. With ``by_channel`` each
    channel has its folder (``sources.channel_paths`` names it), which suits a small registry of
    channels, and a rerun replaces the documents of the channels that it writes. A channel whose
    folder another channel has is an error.

    With a ``compression`` such as gzip every task's file is compressed, to a small part for documents,
    whose lines repeat the names of all fields. All readers here take such files; one task reads one
    whole, as one has written it.
    """
    options = {"ignoreNullFields": "false", "compression": compression}
    if not by_channel:
        docs.write.mode("append").options(**options).json(path)
        return
    names = docs.select("channelName", safe_name(F.col("channelName")).alias("channel"))
    if path_exists(docs.sparkSession, path):
        there = docs.sparkSession.read.schema("channelName STRING, channel STRING").json(path)
        names = names.unionByName(there.join(names.select("channel").distinct(), "channel", "left_semi"))
    clash = names.groupBy("channel").agg(
        F.min("channelName").alias("a"), F.max("channelName").alias("b")
    ).filter("a <> b").first()
    if clash:
        raise ValueError(f"{clash['a']!r} and {clash['b']!r} have the same folder")
    # Rebalancing brings a channel together but splits one that is too large for a task.
    keyed = docs.withColumn("channel", safe_name(F.col("channelName"))).hint("rebalance", "channel")
    writer = keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.options(**options).partitionBy("channel").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Exports rows as UTF-8 CSV with a header, one file per task.

    Quotes within quoted values are doubled. An empty string is written as ``""``, a NULL as
    nothing, and no space is trimmed.
    """
    df.write.mode("overwrite").csv(
        path, header=True, encoding="UTF-8", escape='"', nullValue="", emptyValue='""',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
