"""The channel domain on the given tables: a customer is a channel, an order is a video.

Everything here is derived by Spark from the tables of a data folder and grows with them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat import schemas
from reelstat.functions.times import iso_text
from reelstat.operators.documents import assemble_documents
from reelstat.operators.joins import match
from reelstat.session import fresh_dir
from reelstat.sinks.files import write_documents
from reelstat.sinks.tables import clustered

# The instant up to which the rolling window of the landing documents reaches.
AS_OF = datetime(2001, 8, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str) -> Column:
    """A number without its fraction, as the text an API would send."""
    return F.col(column).cast("int").cast("string")


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel statistics as landed, with the key of the customer."""
    orders = table(spark, sf_dir, "orders")
    totals = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("_videos"),
        F.sum(F.col("o_totalprice").cast("int")).alias("_views"),
    )
    customers = table(spark, sf_dir, "customer")
    return customers.join(totals, "c_custkey", "left").select(
        "c_custkey",
        F.col("c_name").alias("channelName"),
        whole_text("c_acctbal").alias("subscribers"),
        F.coalesce("_views", F.lit(0)).cast("string").alias("views"),
        F.coalesce("_videos", F.lit(0)).cast("string").alias("totalVideos"),
        F.concat(F.lit("PL"), "c_custkey").alias("playlistId"),
    )


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos as landed, with the key of the customer."""
    return owned_orders(spark, sf_dir).select("c_custkey", *video_fields())


def owned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's key under the name it has in the customers' table."""
    return table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")


def video_fields() -> list[Column]:
    """The fields of a landed video, out of an order."""
    nothing = F.lit(None).cast("string")
    return [
        F.col("o_orderkey").cast("string").alias("videoId"),
        F.concat(F.lit("channel "), "c_custkey").alias("channelTitle"),
        F.col("o_orderpriority").alias("title"),
        nothing.alias("description"),
        iso_text(F.col("o_orderdate")).alias("publishedAt"),
        whole_text("o_totalprice").alias("viewCount"),
        nothing.alias("likeCount"),
        nothing.alias("commentCount"),
        F.lit("0").alias("duration"),
        F.col("o_orderstatus").alias("definition"),
    ]


def silent_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as channels that have published nothing."""
    return table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"),
        F.col("s_name").alias("channelName"),
        whole_text("s_acctbal").alias("subscribers"),
        F.lit("0").alias("views"),
        F.lit("0").alias("totalVideos"),
        F.concat(F.lit("PL"), -1 - F.col("s_suppkey")).alias("playlistId"),
    )


def documents(
    spark: SparkSession, sf_dir: str, silent: bool = False, max_items: int = 10_000
) -> DataFrame:
    """Landing documents; with ``silent`` also those of channels whose array is empty."""
    parents = channels(spark, sf_dir)
    if silent:
        parents = parents.unionByName(silent_channels(spark, sf_dir))
    docs = assemble_documents(
        parents, owned_orders(spark, sf_dir), "c_custkey", max_items=max_items, fields=video_fields()
    )
    return docs.drop("c_custkey")


_landed: dict[tuple[str, str, bool], str] = {}


def landing(spark: SparkSession, sf_dir: str, silent: bool = False) -> str:
    """Folder with the landing documents of a data folder; written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, silent)
    if key not in _landed:
        path = fresh_dir(spark, "landing")
        write_documents(documents(spark, sf_dir, silent), path, compression="gzip")
        _landed[key] = path
    return _landed[key]


def land_as(docs: DataFrame, zone: str, files: int) -> None:
    """Lands documents under fixed names, as a job does that writes the same keys every day."""
    spark = docs.sparkSession
    staged = fresh_dir(spark, "staged")
    docs.repartition(files, "channelName").write.option("ignoreNullFields", "false").json(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(zone).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(zone))
    written = sorted(str(x.getPath()) for x in system.listStatus(path(staged)) if "part-" in str(x.getPath()))
    for number, name in enumerate(written):
        target = path(f"{zone}/channels_{number}_raw_data.json")
        system.delete(target, False)
        system.rename(path(name), target)


_stored: dict[tuple[str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated rows as files by year and month; written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        path = fresh_dir(spark, "stored")
        clustered(curated(spark, sf_dir)).write.partitionBy(*schemas.PARTITION_FIELDS).parquet(path)
        _stored[key] = path
    return spark.read.schema(schemas.curated()).parquet(_stored[key])


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated rows straight from the tables, without the detour over documents."""
    orders = table(spark, sf_dir, "orders")
    totals = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("_videos")
    )
    owners = table(spark, sf_dir, "customer").join(totals, "c_custkey", "left").select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_name").alias("channelName"),
        F.col("c_acctbal").cast("int").alias("subscribers"),
        F.coalesce("_videos", F.lit(0)).cast("int").alias("totalVideos"),
    )
    published = F.col("o_orderdate").cast("timestamp")
    return (
        match(orders, owners, ["o_custkey"])
        .select(
            "channelName",
            "subscribers",
            "totalVideos",
            F.col("o_orderpriority").alias("video_title"),
            published.alias("publishedAt"),
            F.col("o_totalprice").cast("int").alias("viewCount"),
            F.year(published).alias("year"),
            F.month(published).alias("month"),
        )
        .select(*schemas.CURATED_FIELDS)
    )
