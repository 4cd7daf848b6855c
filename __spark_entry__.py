"""

A customer stands for a channel and an order for a video (see ``reelstat.testbed``). Queries that
write do so below the folder that ``spark.checkpoint.dir`` names, never in the data folder.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The package lies next to this file, which may be loaded from anywhere.
sys.path.insert(0, str(Path(__file__).resolve().parent))

from reelstat import schemas, sinks, sources, testbed
from reelstat.functions import (
    count_of, instant_of, iso_text, month_key, object_key, or_default, published_since, safe_name,
)
from reelstat.operators import assemble_documents as assemble_documents_of
from reelstat.operators import (
    chunk_ids, expand_nested, explode_videos, flatten_chain, flatten_pages, positions,
)
from reelstat.plans import explore, reports, states
from reelstat.plans.curate import curate
from reelstat.plans.rules import Rule, visible
from reelstat.session import fresh_database, fresh_dir, written
from reelstat.streaming import committed, ingest_landing

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

# The curated rows, in SQL.
CUR = """
WITH cur AS (
  SELECT c_name AS "channelName", CAST(trunc(c_acctbal) AS INTEGER) AS subscribers,
         CAST(count(*) OVER (PARTITION BY c_custkey) AS INTEGER) AS "totalVideos",
         o_orderpriority AS video_title, o_orderdate AS "publishedAt",
         CAST(trunc(o_totalprice) AS INTEGER) AS "viewCount",
         CAST(year(o_orderdate) AS INTEGER) AS "year",
         CAST(month(o_orderdate) AS INTEGER) AS "month"
  FROM customer JOIN orders ON c_custkey = o_custkey
)
"""
# The orders inside the rolling window of the landing documents, in SQL.
RECENT = "o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 365 DAY"


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query with its SQL, if there is one.

    It goes by its function's name, unless that would hide an imported one and ``name`` is given.
    """

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir)

        key = name or function.__name__
        _QUERIES[key] = run
        if oracle:
            _ORACLES[key] = oracle
        return run

    return register


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as the plain ones the tables hold."""
    plain = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name)
        for f in df.schema
    ]
    return df.select(*plain)


def landed(
    spark: SparkSession, sf_dir: str, schema: T.StructType | None = None, silent: bool = False
) -> DataFrame:
    return sources.read_landing(spark, testbed.landing(spark, sf_dir, silent), schema)


# ---------------------------------------------------------------- sources


def document_summary(docs: DataFrame) -> DataFrame:
    """Counts of each channel's document, or of all its parts where it was split."""
    return docs.groupBy("channelName").agg(
        F.max("subscribers").alias("subscribers"),
        F.max("totalVideos").alias("totalVideos"),
        F.sum(F.size("videos")).alias("n_videos"),
    )


DOCUMENT_SUMMARY = """
SELECT c_name AS "channelName", CAST(CAST(trunc(c_acctbal) AS INTEGER) AS VARCHAR) AS subscribers,
       CAST(count(o_orderkey) AS VARCHAR) AS "totalVideos", count(o_orderkey) AS n_videos
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name, c_acctbal
"""


@query(DOCUMENT_SUMMARY)
def scan_json_landing(spark, sf_dir):
    return document_summary(landed(spark, sf_dir))


@query("""
SELECT c_name AS "channelName", 2 * count(o_orderkey) AS n
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name
UNION ALL SELECT s_name, 0 FROM supplier
""")
def scan_multi_source(spark, sf_dir):
    """Two landing zones in one read; the second also has channels without videos."""
    paths = [testbed.landing(spark, sf_dir), testbed.landing(spark, sf_dir, silent=True)]
    docs = sources.read_landing(spark, paths, schemas.landing(["channelName"], ["videoId"]))
    return docs.groupBy("channelName").agg(F.sum(F.size("videos")).alias("n"))


@query(CUR + "SELECT * FROM cur")
def scan_curated(spark, sf_dir):
    table = f"{fresh_database(spark)}.curated"
    sinks.create_curated(spark, table)
    sinks.append_curated(testbed.curated(spark, sf_dir), table)
    return without_zone(spark.table(table))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS _c0, o_orderstatus AS _c2 FROM orders")
def scan_csv_headerless(spark, sf_dir):
    path = fresh_dir(spark, "csv")
    testbed.table(spark, sf_dir, "orders").write.csv(path)
    return sources.read_csv_headerless(spark, path).select("_c0", "_c2")


@query("""
SELECT c_name AS "channelName", count(o_orderkey) AS n_videos
FROM customer LEFT JOIN orders ON c_custkey = o_custkey
WHERE c_name IN ('Customer#000000001', 'Customer#000000002') GROUP BY c_custkey, c_name
""")
def scan_channel_subset(spark, sf_dir):
    docs = landed(spark, sf_dir, schemas.landing(["channelName"], ["videoId"]))
    chosen = sources.of_channels(docs, ["Customer#000000001", "Customer#000000002"])
    return chosen.groupBy("channelName").agg(F.sum(F.size("videos")).alias("n_videos"))


@query("""
SELECT n_name AS "channelName", count(o_orderkey) AS n_videos, max(o_orderkey) AS last_video
FROM nation JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey
WHERE n_nationkey IN (3, 7) GROUP BY 1
""")
def scan_channel_paths(spark, sf_dir):
    """Nations as channels, landed by channel twice; two of them are read by their paths."""
    tables = {name: testbed.table(spark, sf_dir, name) for name in ["nation", "customer", "orders"]}
    parents = tables["nation"].select("n_nationkey", F.col("n_name").alias("channelName"))
    children = tables["orders"].join(tables["customer"], F.col("o_custkey") == F.col("c_custkey"))
    docs = assemble_documents_of(
        parents, children.select(F.col("c_nationkey").alias("n_nationkey"), F.col("o_orderkey").alias("id")),
        "n_nationkey", max_items=1_000,
    )
    zone = fresh_dir(spark, "by-channel")
    for _ in range(2):
        sinks.write_documents(docs, zone, by_channel=True)
    names = [r[0] for r in parents.filter("n_nationkey IN (3, 7)").select("channelName").collect()]
    schema = T.StructType.fromDDL("channelName STRING, videos ARRAY<STRUCT<id: BIGINT>>")
    chosen = sources.read_landing(spark, sources.channel_paths(zone, names), schema)
    return chosen.groupBy("channelName").agg(
        F.sum(F.size("videos")).alias("n_videos"), F.max(F.array_max("videos.id")).alias("last_video")
    )


@query("SELECT count(*) AS n_documents, CAST(0 AS BIGINT) AS n_without_size FROM customer")
def landing_manifest(spark, sf_dir):
    """Documents in the files that the manifest lists, all of which must have a size."""
    zone = testbed.landing(spark, sf_dir)
    plain = lambda path: F.regexp_replace(path, "^file:/+", "file:/")
    listed = sources.landing_manifest(spark, zone).select(plain(F.col("path")).alias("path"), "length")
    docs = sources.read_landing(spark, zone, schemas.landing(["channelName"], []), with_source=True)
    counts = docs.groupBy(plain(F.col("source")).alias("path")).agg(F.count("*").alias("n"))
    return listed.join(counts, "path").agg(
        F.sum("n").alias("n_documents"), F.sum((F.col("length") <= 0).cast("int")).alias("n_without_size")
    )


def ingested(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Two runs, each after a new drop: first the older videos, then those of the last year.
    Returns the table, the landing zone and the archive."""
    zone, checkpoint, archive = (fresh_dir(spark, name) for name in ["drop", "progress", "archive"])
    table = f"{fresh_database(spark)}.curated"
    docs = landed(spark, sf_dir)
    for keep in [lambda video: ~since_of(video), since_of]:
        sinks.write_documents(docs.withColumn("videos", F.filter("videos", keep)), zone, compression="gzip")
        ingest_landing(spark, zone, table, checkpoint, archive)
    return table, zone, archive


@query(CUR + """SELECT * FROM cur UNION ALL SELECT * FROM cur WHERE "year" = 1997""")
def incremental_landing(spark, sf_dir):
    """The table after two runs, and rows appended by another writer."""
    table, _, _ = ingested(spark, sf_dir)
    sinks.append_rows(testbed.curated(spark, sf_dir).filter(F.col("year") == 1997), table)
    return without_zone(spark.table(table))


@query(CUR + "SELECT *, CAST(0 AS BIGINT) AS n_left FROM cur")
def incremental_relanding(spark, sf_dir):
    """Two drops under the same file names, the second of which lands when the first has been read
    and deleted, and the files left after that."""
    zone, checkpoint, table = fresh_dir(spark, "drop"), fresh_dir(spark, "progress"), f"{fresh_database(spark)}.curated"
    docs = landed(spark, sf_dir)
    for keep in [lambda video: ~since_of(video), since_of]:
        testbed.land_as(docs.withColumn("videos", F.filter("videos", keep)), zone, 4)
        ingest_landing(spark, zone, table, checkpoint, delete=True)
    left = sources.landing_manifest(spark, zone).agg(F.count("*").alias("n_left"))
    return without_zone(spark.table(table)).crossJoin(F.broadcast(left))


BY_CHANNEL = """
SELECT c_name AS "channelName", CAST(trunc(c_acctbal) AS INTEGER) AS subscribers, count(o_orderkey) AS n
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name, c_acctbal
"""


@query(f"""
SELECT 'document' AS reason, count(*) AS n, CAST(sum(n) AS BIGINT) AS n_videos
FROM ({BY_CHANNEL}) WHERE subscribers % 10 NOT IN (3, 5, 7) OR subscribers < 0
UNION ALL SELECT CASE subscribers % 10 WHEN 3 THEN 'malformed' WHEN 5 THEN 'no channel name'
                 ELSE 'wrong type' END, count(*), 0
FROM ({BY_CHANNEL}) WHERE subscribers % 10 IN (3, 5, 7) AND subscribers >= 0 GROUP BY 1
""")
def quarantine_lines(spark, sf_dir):
    """Landed lines, many of which are cut off, have a wrong type or no name, through ingestion: the
    documents, and the others by what is wrong with them."""
    zone, checkpoint, bad = (fresh_dir(spark, name) for name in ["drop", "progress", "quarantine"])
    table = f"{fresh_database(spark)}.curated"
    last = F.col("subscribers").cast("int") % 10
    docs = landed(spark, sf_dir, schemas.landing(["channelName", "subscribers", "totalVideos"]))
    docs = docs.withColumn("channelName", F.when(last == 5, None).otherwise(F.col("channelName")))
    line = F.to_json(F.struct(*docs.columns))
    broken = F.when(last == 3, F.expr("left(line, length(line) - 2)")).when(
        last == 7, F.regexp_replace("line", '"videos":.*', '"videos":7}')
    ).otherwise(F.col("line"))
    docs.withColumn("line", line).select(broken.alias("value")).write.text(zone)
    ingest_landing(spark, zone, table, checkpoint, delete=True, quarantine=bad)
    good = documents_of_channels(spark, sf_dir, last).join(
        spark.table(table).groupBy("channelName").agg(F.count("*").alias("n")), "channelName", "left"
    )
    reasons = spark.read.parquet(bad).groupBy("reason").agg(
        F.count("*").alias("n"), F.lit(0).cast("bigint").alias("n_videos")
    )
    return good.agg(F.lit("document").alias("reason"), F.count("*").alias("n"), F.sum("n").alias("n_videos")).unionByName(reasons)


def documents_of_channels(spark: SparkSession, sf_dir: str, last: Column) -> DataFrame:
    """Names of the channels whose landed lines are right."""
    docs = landed(spark, sf_dir, schemas.landing(["channelName", "subscribers"], []))
    return docs.filter(~last.isin(3, 5, 7)).select("channelName").distinct()


@query("""
SELECT c_name AS "channelName", n_name AS country, count(o_orderkey) AS n_videos
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN orders ON c_custkey = o_custkey
GROUP BY c_custkey, c_name, n_name
UNION ALL SELECT c_name, NULL, count(o_orderkey)
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name
""")
def unknown_fields(spark, sf_dir):
    """Two drops, the second with a field that the schema does not name."""
    zone = fresh_dir(spark, "drop")
    docs = testbed.documents(spark, sf_dir)
    sinks.write_documents(docs, zone)
    customers, nations = (testbed.table(spark, sf_dir, name) for name in ["customer", "nation"])
    named = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    country = named.select(F.col("c_name").alias("channelName"), F.struct(F.col("n_name").alias("name")).alias("country"))
    sinks.write_documents(docs.join(country, "channelName"), zone)
    read = sources.landing_with_rest(spark, zone, schemas.landing(["channelName"], ["videoId"]))
    place = F.try_variant_get("rest", "$.country.name", "string")
    return read.groupBy("channelName", place.alias("country")).agg(F.sum(F.size("videos")).alias("n_videos"))


@query("""
SELECT c_name AS "channelName",
       CASE WHEN c_custkey % 3 = 0 THEN 'third' WHEN c_custkey % 2 = 0 THEN 'second' ELSE 'first' END AS landing,
       count(o_orderkey) AS n_videos, CAST(0 AS BIGINT) AS n_stale
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name
""")
def document_versions(spark, sf_dir):
    """Three landings under the channels' names, compacted, and the documents out of date after that."""
    path, schema = fresh_dir(spark, "versions"), schemas.landing(["channelName", "playlistId"], ["videoId"])
    docs = testbed.documents(spark, sf_dir)
    number = F.substring("channelName", 10, 9).cast("int")
    for version, (name, kept) in enumerate([("first", F.lit(True)), ("second", number % 2 == 0), ("third", number % 3 == 0)]):
        videos = F.transform("videos", lambda v: F.struct(v["videoId"].alias("videoId")))
        chosen = docs.filter(kept).select("channelName", F.lit(name).alias("playlistId"), videos.alias("videos"))
        sinks.land_version(chosen, path, "channelName", version)
    sinks.compact_versions(spark, path, schema, "channelName")
    rows = spark.read.parquet(path).select("channelName", "version").distinct().groupBy("channelName").agg(
        F.count("*") - 1).toDF("channelName", "n_stale")
    current = sinks.current_documents(spark, path, schema, "channelName")
    return current.groupBy("channelName", F.col("playlistId").alias("landing")).agg(
        F.sum(F.size("videos")).alias("n_videos")
    ).join(rows, "channelName")


@query("SELECT CAST(0 AS BIGINT) AS n_left, 2 * count(*) AS n_archived FROM customer")
def incremental_cleanup(spark, sf_dir):
    """Documents that two runs leave in the landing zone, and those they put into the archive."""
    _, zone, archive = ingested(spark, sf_dir)
    schema = schemas.landing(["channelName"], [])
    left, put = (sources.read_landing(spark, path, schema) for path in (zone, archive))
    both = left.select(F.lit(True).alias("left")).unionAll(put.select(F.lit(False)))
    return both.agg(
        F.count(F.when(F.col("left"), 1)).alias("n_left"),
        F.count(F.when(~F.col("left"), 1)).alias("n_archived"),
    )


def since_of(video: Column) -> Column:
    return published_since(video["publishedAt"], testbed.AS_OF, iso=True)


# ---------------------------------------------------------------- sinks and tables


@query(DOCUMENT_SUMMARY)
def sink_json_documents(spark, sf_dir):
    path = fresh_dir(spark, "documents")
    sinks.write_documents(testbed.documents(spark, sf_dir), path)
    return document_summary(sources.read_landing(spark, path))


@query(CUR + """
SELECT "channelName", 2 * count(video_title) AS n, max("viewCount") AS "maxViews"
FROM cur GROUP BY 1
""")
def sink_append_curated(spark, sf_dir):
    table = f"{fresh_database(spark)}.curated"
    sinks.create_curated(spark, table)
    for _ in range(2):
        sinks.append_curated(testbed.curated(spark, sf_dir), table)
    return spark.table(table).groupBy("channelName").agg(
        F.count("video_title").alias("n"), F.max("viewCount").alias("maxViews")
    )


@query(CUR + 'SELECT * FROM cur WHERE "year" = 1997')
def partition_prune(spark, sf_dir):
    return without_zone(testbed.stored(spark, sf_dir).filter(F.col("year") == 1997))


@query(CUR + """
SELECT "year", count(*) AS n, max("viewCount") AS "maxViews" FROM cur GROUP BY 1
""")
def sink_overwrite_partitions(spark, sf_dir):
    """All years, then the year 1997 again: its partitions are replaced, the others stay."""
    table = f"{fresh_database(spark)}.curated"
    rows = testbed.curated(spark, sf_dir)
    sinks.create_curated(spark, table)
    sinks.append_curated(rows, table)
    sinks.overwrite_partitions(rows.filter(F.col("year") == 1997), table)
    return spark.table(table).groupBy("year").agg(
        F.count("*").alias("n"), F.max("viewCount").alias("maxViews")
    )


@query(CUR + """
SELECT "channelName", max(subscribers) AS "totalSubscribers" FROM cur GROUP BY 1
""")
def sink_replace_report(spark, sf_dir):
    table = f"{fresh_database(spark)}.channel_subscribers"
    for _ in range(2):
        sinks.replace_table(reports.channel_subscribers(testbed.curated(spark, sf_dir)), table)
    return spark.table(table)


@query(CUR + """
SELECT s."channelName", s."totalSubscribers", c."totalVideosPublished", t.n_months, t.n_in_months,
       t.by_month, v.n_titles, v.views
FROM (SELECT "channelName", max(subscribers) AS "totalSubscribers" FROM cur GROUP BY 1) s
JOIN (SELECT "channelName", count(video_title) AS "totalVideosPublished" FROM cur GROUP BY 1) c
  USING ("channelName")
JOIN (SELECT "channelName", count(*) AS n_months, CAST(sum(n) AS BIGINT) AS n_in_months,
             CAST(sum(n * ("year" * 12 + "month")) AS BIGINT) AS by_month
      FROM (SELECT "channelName", "year", "month", count(video_title) AS n FROM cur GROUP BY 1, 2, 3)
      GROUP BY 1) t
  USING ("channelName")
JOIN (SELECT "channelName", count(*) AS n_titles, CAST(sum("maxViews") AS BIGINT) AS views
      FROM (SELECT "channelName", video_title, max("viewCount") AS "maxViews" FROM cur GROUP BY 1, 2)
      GROUP BY 1) v
  USING ("channelName")
""")
def report_tables(spark, sf_dir):
    """The four report tables written from the curated table, then read side by side."""
    database = fresh_database(spark)
    sinks.create_curated(spark, f"{database}.curated")
    sinks.append_curated(testbed.curated(spark, sf_dir), f"{database}.curated")
    names = reports.write_reports(spark.table(f"{database}.curated"), f"{database}.")
    return side_by_side(spark, names)


REPORT_NAMES = ["channel_subscribers", "video_count", "video_trend", "most_viewed_videos"]


def side_by_side(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    """The four report tables, by channel."""
    count = F.col("monthlyVideosPublished")
    trend = spark.table(names["video_trend"]).groupBy("channelName").agg(
        F.count("*").alias("n_months"), F.sum(count).alias("n_in_months"),
        F.sum(count * (F.col("year") * 12 + F.col("month"))).alias("by_month"),
    )
    titles = spark.table(names["most_viewed_videos"]).groupBy("channelName").agg(
        F.count("*").alias("n_titles"), F.sum("totalViews").alias("views")
    )
    return (
        spark.table(names["channel_subscribers"])
        .join(spark.table(names["video_count"]), "channelName")
        .join(trend, "channelName")
        .join(titles, "channelName")
    )


def by_year(spark: SparkSession, sf_dir: str) -> tuple[str, str, int]:
    """Three landings by years, each ingested and the reports brought up to date after it. Returns
    the table, the prefix of the reports and the last batch."""
    database, zone, checkpoint = fresh_database(spark), fresh_dir(spark, "drop"), fresh_dir(spark, "progress")
    table, prefix = f"{database}.curated", f"{database}.kept_"
    docs, last = landed(spark, sf_dir), -1
    year = lambda v: F.substring(v["publishedAt"], 1, 4).cast("int")
    for low, high in [(0, 1996), (1997, 1999), (2000, 9999)]:
        part = F.filter("videos", lambda v: year(v).between(low, high))  # noqa: B023
        sinks.write_documents(docs.withColumn("videos", part), zone, compression="gzip")
        ingest_landing(spark, zone, table, checkpoint, delete=True)
        last = committed(spark, checkpoint)
        states.update_reports(spark, table, last, prefix)
    return table, prefix, last


@query(_ORACLES["report_tables"])
def reports_by_batch(spark, sf_dir):
    """The report tables after three batches, from states that take up one batch at a time."""
    _, prefix, _ = by_year(spark, sf_dir)
    return side_by_side(spark, {name: f"{prefix}{name}" for name in REPORT_NAMES})


@query(CUR + """
SELECT field, value, n FROM (
  SELECT 'channelName' AS field, "channelName" AS value, count(*) AS n FROM cur
  WHERE starts_with("channelName", 'Customer#0000001') GROUP BY 2
  UNION ALL SELECT 'video_title', video_title, count(*) FROM cur GROUP BY 2
)
""")
def filter_dictionary(spark, sf_dir):
    """Values to choose from, out of a table that takes up batch after batch."""
    table, prefix, last = by_year(spark, sf_dir)
    state = states.values_of("channelName", "video_title")
    for until in range(last + 1):
        name = states.advance(spark, state, table, until, prefix)
    return states.choices(spark.table(name), "channelName", explore.FILTER_SEARCH_ROWS, "Customer#0000001").select(
        F.lit("channelName").alias("field"), "value", "n"
    ).unionAll(states.choices(spark.table(name), "video_title", explore.FILTER_ROWS).select(
        F.lit("video_title").alias("field"), "value", "n"))


@query(CUR + """
SELECT "year", "month", count(*) AS n, max("viewCount") AS "maxViews", CAST(1 AS BIGINT) AS n_files
FROM cur GROUP BY 1, 2
""")
def compact_small_files(spark, sf_dir):
    """Ten appends, one for each last digit of the day, and then one file a month."""
    table = f"{fresh_database(spark)}.curated"
    rows = testbed.curated(spark, sf_dir)
    sinks.create_curated(spark, table)
    for day in range(10):
        sinks.append_curated(rows.filter(F.dayofmonth("publishedAt") % 10 == day), table)
    sinks.compact_table(spark, table)
    meta = F.col("_metadata.file_path")
    return spark.table(table).withColumn("file", meta).groupBy("year", "month").agg(
        F.count("*").alias("n"), F.max("viewCount").alias("maxViews"),
        F.count_distinct("file").alias("n_files"),
    )


@query(CUR + 'SELECT "year", count(*) AS n FROM cur GROUP BY 1')
def sink_truncate_reload(spark, sf_dir):
    table = f"{fresh_database(spark)}.curated"
    rows = testbed.curated(spark, sf_dir)
    sinks.create_curated(spark, table)
    sinks.append_curated(rows, table)
    sinks.reload_curated(rows, table)
    return spark.table(table).groupBy("year").agg(F.count("*").alias("n"))


TOP_PER_CHANNEL = CUR + """
SELECT "channelName", video_title, "viewCount", "publishedAt",
       CAST(row_number() OVER (PARTITION BY "channelName"
            ORDER BY "viewCount" DESC NULLS LAST, video_title NULLS FIRST,
                     "publishedAt" NULLS FIRST) AS INTEGER) AS rank
FROM cur QUALIFY rank <= 5
"""


@query(TOP_PER_CHANNEL)
def sink_append_legacy(spark, sf_dir):
    """One table for the top videos of all channels, with the channel as a column."""
    table = f"{fresh_database(spark)}.most_viewed_videos"
    sinks.append_table(reports.top_videos_per_channel(testbed.curated(spark, sf_dir)), table)
    return without_zone(spark.table(table))


@query(CUR + """
SELECT "channelName", m.n_months, m.n_videos, t.n_top, t.views, max(subscribers) AS subscribers
FROM cur
JOIN (SELECT "channelName", count(*) AS n_months, CAST(sum(n) AS BIGINT) AS n_videos
      FROM (SELECT "channelName", strftime("publishedAt", '%Y-%m') AS k, count(*) AS n
            FROM cur GROUP BY 1, 2) GROUP BY 1) m USING ("channelName")
JOIN (SELECT "channelName", count(*) AS n_top, CAST(sum("viewCount") AS BIGINT) AS views
      FROM (SELECT "channelName", "viewCount" FROM cur QUALIFY row_number() OVER (
            PARTITION BY "channelName" ORDER BY "viewCount" DESC NULLS LAST, video_title NULLS FIRST,
            "publishedAt" NULLS FIRST) <= 5) GROUP BY 1) t USING ("channelName")
GROUP BY 1, 2, 3, 4, 5
""")
def legacy_tables(spark, sf_dir):
    """The three tables of the former job, written and read side by side."""
    names = reports.append_channel_tables(testbed.curated(spark, sf_dir), f"{fresh_database(spark)}.")
    months = spark.table(names["trend_data"]).groupBy("channelName").agg(
        F.count("*").alias("n_months"), F.sum("count").alias("n_videos")
    )
    top = spark.table(names["most_viewed_videos"]).groupBy("channelName").agg(
        F.count("*").alias("n_top"), F.sum("viewCount").alias("views")
    )
    summary = spark.table(names["report"]).select(
        F.col("channel_name").alias("channelName"), F.col("subscribers").cast("int").alias("subscribers")
    )
    return months.join(top, "channelName").join(summary, "channelName")


@query(CUR + """
SELECT "channelName", strftime("publishedAt", '%Y-%m') AS publish_month, count(*) AS "count"
FROM cur GROUP BY 1, 2
""")
def trend_per_channel(spark, sf_dir):
    return reports.trend_per_channel(testbed.stored(spark, sf_dir))


@query(CUR + """
SELECT "channelName" AS channel_name, CAST(max(subscribers) AS VARCHAR) AS subscribers,
       CAST(max("totalVideos") AS VARCHAR) AS total_videos,
       replace("channelName", ' ', '_') || '_trend_data' AS trend_data_table,
       replace("channelName", ' ', '_') || '_most_viewed_videos' AS most_viewed_videos_table
FROM cur GROUP BY "channelName"
""")
def channel_report(spark, sf_dir):
    return reports.channel_report(testbed.stored(spark, sf_dir))


@query(CUR + """
SELECT * FROM cur ORDER BY "channelName", "publishedAt", video_title, "viewCount" LIMIT 20
""")
def preview_rows(spark, sf_dir):
    rows = testbed.stored(spark, sf_dir)
    order = ["channelName", "publishedAt", "video_title", "viewCount"]
    return without_zone(explore.limited(rows.orderBy(*order), 20))


# ---------------------------------------------------------------- projections and functions


@query(CUR + "SELECT * FROM cur", name="curate")
def curate_documents(spark, sf_dir):
    docs = landed(spark, sf_dir, schemas.landing_for_curate())
    return without_zone(curate(docs))


@query("""
SELECT c_name AS "channelName", count(*) AS n
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1
""", name="explode_videos")
def explode_videos_inner(spark, sf_dir):
    """Channels without videos are in the documents and give no row."""
    docs = landed(spark, sf_dir, schemas.landing(["channelName"], ["videoId"]), silent=True)
    return explode_videos(docs).groupBy("channelName").agg(F.count("*").alias("n"))


@query("""
SELECT c_custkey, try_cast(substring(c_name, 10) AS INTEGER) AS number,
       try_cast(c_mktsegment AS INTEGER) AS bad
FROM customer
""")
def cast_counts(spark, sf_dir):
    return testbed.table(spark, sf_dir, "customer").select(
        "c_custkey",
        count_of(F.substring("c_name", 10, 9)).alias("number"),
        count_of(F.col("c_mktsegment")).alias("bad"),
    )


@query("""
SELECT o_orderkey, o_orderdate AS published, try_cast(o_orderstatus AS TIMESTAMP) AS bad FROM orders
""")
def cast_timestamps(spark, sf_dir):
    orders = testbed.table(spark, sf_dir, "orders")
    return without_zone(
        orders.select(
            "o_orderkey",
            instant_of(iso_text(F.col("o_orderdate"))).alias("published"),
            instant_of(F.col("o_orderstatus")).alias("bad"),
        )
    )


@query("""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS "year",
       CAST(month(o_orderdate) AS INTEGER) AS "month"
FROM orders
""")
def year_month_parts(spark, sf_dir):
    published = F.col("o_orderdate")
    return testbed.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year(published).alias("year"), F.month(published).alias("month")
    )


@query("""
SELECT strftime(o_orderdate, '%Y-%m') AS publish_month, count(*) AS "count" FROM orders GROUP BY 1
""")
def trend_by_month_key(spark, sf_dir):
    videos = testbed.videos(spark, sf_dir)
    return reports.trend_by_month(videos, month_key(F.col("publishedAt")))


@query(CUR + f"""
SELECT * FROM cur WHERE "publishedAt" >= {RECENT.split(">= ")[1]}
""")
def curated_rolling_window(spark, sf_dir):
    """The rolling window on the curated table, where it also prunes partitions."""
    table = f"{fresh_database(spark)}.curated"
    sinks.create_curated(spark, table)
    sinks.append_curated(testbed.curated(spark, sf_dir), table)
    return without_zone(
        sources.curated_since(sources.read_curated(spark, table), testbed.AS_OF)
    )


@query(f"SELECT o_orderkey FROM orders WHERE {RECENT}")
def rolling_window_filter(spark, sf_dir):
    orders = testbed.table(spark, sf_dir, "orders")
    return orders.filter(published_since(F.col("o_orderdate"), testbed.AS_OF)).select("o_orderkey")


@query("""
SELECT o_orderkey, o_orderdate >= TIMESTAMP '2000-07-31 16:00:00' AS by_text,
       o_orderdate >= TIMESTAMP '2000-07-31 16:00:00' AS by_time
FROM orders
""")
def rolling_window_zones(spark, sf_dir):
    """API text and timestamps against the same cutoff, in a session that is not in UTC."""
    text = testbed.videos(spark, sf_dir).select(
        F.col("videoId").cast("bigint").alias("o_orderkey"), "publishedAt"
    )
    spark.conf.set("spark.sql.session.timeZone", "Asia/Singapore")
    try:
        out = text.select(
            "o_orderkey",
            published_since(F.col("publishedAt"), testbed.AS_OF, iso=True).alias("by_text"),
            published_since(instant_of(F.col("publishedAt")), testbed.AS_OF).alias("by_time"),
        )
        return written(out, "zones")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def props_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as JSON text in which the key is missing for events of type error."""
    events = testbed.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    present = F.when(F.col("event_type") != "error", k)
    text = F.to_json(F.struct(present.alias("k")))
    return events.select("event_id", F.from_json(text, "k STRING")["k"].alias("k"))


@query("""
SELECT event_id, CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS k
FROM events
""")
def json_missing_fields(spark, sf_dir):
    return props_with_gaps(spark, sf_dir)


@query("""
SELECT event_id,
       CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') ELSE '0' END AS k
FROM events
""")
def default_value(spark, sf_dir):
    return props_with_gaps(spark, sf_dir).withColumn("k", or_default(F.col("k")))


@query("SELECT o_orderkey, replace(o_orderpriority, ' ', '_') AS safe FROM orders")
def normalize_name(spark, sf_dir):
    return testbed.table(spark, sf_dir, "orders").select(
        "o_orderkey", safe_name(F.col("o_orderpriority")).alias("safe")
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_extract(spark, sf_dir):
    parsed = F.from_json("props", "k INT")
    return testbed.table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


def response(items: Column, **more: Column) -> Column:
    """A response around an array of items, as JSON text."""
    fields = [value.alias(name) for name, value in more.items()]
    return F.to_json(F.struct(items.alias("items"), *fields)).alias("response")


@query("""
SELECT c_custkey, c_name AS "channelName",
       CAST(CAST(trunc(c_acctbal) AS INTEGER) AS VARCHAR) AS subscribers,
       CAST(c_nationkey AS VARCHAR) AS views, CAST(NULL AS VARCHAR) AS "totalVideos",
       'PL' || CAST(c_custkey AS VARCHAR) AS "playlistId"
FROM customer
""")
def json_extract_channels(spark, sf_dir):
    """Channel statistics out of one nested response per customer; one count is missing."""
    item = F.struct(
        F.struct(F.col("c_name").alias("title")).alias("snippet"),
        F.struct(
            testbed.whole_text("c_acctbal").alias("subscriberCount"),
            F.col("c_nationkey").cast("string").alias("viewCount"),
        ).alias("statistics"),
        F.struct(
            F.struct(F.concat(F.lit("PL"), "c_custkey").alias("uploads")).alias("relatedPlaylists")
        ).alias("contentDetails"),
    )
    customers = testbed.table(spark, sf_dir, "customer")
    return sources.channels_from_responses(
        customers.select("c_custkey", response(F.array(item)))
    )


def order_pages(spark: SparkSession, sf_dir: str, item: Column) -> DataFrame:
    """Orders in pages: those of one priority out of 50 neighbouring keys, so 50 at most."""
    page = F.expr("o_orderkey div 50").alias("page")
    return (
        testbed.table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("channelName"), page)
        .agg(F.sort_array(F.collect_list(F.struct("o_orderkey", item.alias("item")))).alias("rows"))
        .select("channelName", "page", F.col("rows.item").alias("items"))
    )


@query(f"""
SELECT o_orderpriority AS "channelName", CAST(o_orderkey AS VARCHAR) AS "videoId",
       o_orderpriority AS title, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS "publishedAt",
       CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(trunc(o_totalprice) AS INTEGER) AS VARCHAR) END
         AS "viewCount",
       CAST(NULL AS VARCHAR) AS "likeCount",
       CASE WHEN o_orderstatus <> 'O' THEN 'PT1M' ELSE '0' END AS duration
FROM orders WHERE {RECENT}
""")
def json_extract_videos(spark, sf_dir):
    """Videos of the last 365 days out of nested responses of up to 50 items with gaps."""
    item = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.struct(
            F.col("o_orderpriority").alias("title"),
            iso_text(F.col("o_orderdate")).alias("publishedAt"),
        ).alias("snippet"),
        F.struct(
            F.when(F.col("o_orderstatus") != "P", testbed.whole_text("o_totalprice")).alias(
                "viewCount"
            )
        ).alias("statistics"),
        F.struct(F.when(F.col("o_orderstatus") != "O", F.lit("PT1M")).alias("duration")).alias(
            "contentDetails"
        ),
    )
    responses = order_pages(spark, sf_dir, item).select("channelName", response(F.col("items")))
    return sources.videos_from_responses(responses, testbed.AS_OF).select(
        "channelName", "videoId", "title", "publishedAt", "viewCount", "likeCount", "duration"
    )


@query("""
SELECT o_orderkey,
       to_json({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus})::VARCHAR AS json
FROM orders
""")
def json_serialize(spark, sf_dir):
    record = F.struct("o_orderkey", "o_orderstatus")
    return testbed.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_json(record).alias("json")
    )


@query("""
SELECT c_custkey,
       replace(c_mktsegment, ' ', '_') || '/' || replace(c_name, ' ', '_') || '_raw_data.json'
         AS object_key
FROM customer
""", name="object_key")
def object_key_names(spark, sf_dir):
    key = object_key(F.col("c_mktsegment"), F.col("c_name"))
    return testbed.table(spark, sf_dir, "customer").select("c_custkey", key.alias("object_key"))


# ---------------------------------------------------------------- documents, pages, chunks


@query("""
SELECT c_name AS "channelName", count(o_orderkey) AS n_videos,
       max(CAST(trunc(o_totalprice) AS INTEGER)) AS "maxViews"
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name
""")
def assemble_documents(spark, sf_dir):
    most = F.array_max(F.transform("videos", lambda video: video["viewCount"].cast("int")))
    return (
        testbed.documents(spark, sf_dir)
        .groupBy("channelName")
        .agg(F.sum(F.size("videos")).alias("n_videos"), F.max(most).alias("maxViews"))
    )


LISTED = """
SELECT o_orderpriority AS "channelName", o_orderkey AS "videoId",
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS position
FROM orders
"""


@query("""
SELECT c_name AS "channelName", part, parts, CAST(least(4, n - 4 * part) AS INTEGER) AS n_videos
FROM (SELECT c_name, n, greatest(1, CAST(ceil(n / 4.0) AS BIGINT)) AS parts,
             unnest(range(greatest(1, CAST(ceil(n / 4.0) AS BIGINT)))) AS part
      FROM (SELECT c_name, count(o_orderkey) AS n
            FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name))
""")
def assemble_documents_in_parts(spark, sf_dir):
    """Documents of four videos at most."""
    docs = testbed.documents(spark, sf_dir, max_items=4)
    return docs.select("channelName", "part", "parts", F.size("videos").alias("n_videos"))


@query(LISTED, name="flatten_pages")
def flatten_id_pages(spark, sf_dir):
    pages = order_pages(spark, sf_dir, F.col("o_orderkey"))
    return flatten_pages(pages, "channelName", "page", "items")


@query("""
SELECT o_orderpriority AS "channelName", CAST(o_orderkey AS VARCHAR) AS "videoId",
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS position
FROM orders
""")
def flatten_token_chain(spark, sf_dir):
    """The same ids out of responses that have no page number, only tokens."""
    item = F.struct(F.struct(F.col("o_orderkey").cast("string").alias("videoId")).alias("contentDetails"))
    pages = order_pages(spark, sf_dir, item)
    token = lambda page: F.md5(F.concat_ws("-", "channelName", page.cast("string")))
    own = Window.partitionBy("channelName").orderBy("page")
    after, before = F.lead("page").over(own), F.lag("page").over(own)
    responses = pages.withColumns({"after": after, "before": before}).select(
        "channelName", F.when(F.col("before").isNotNull(), token(F.col("page"))).alias("pageToken"),
        response(F.col("items"), nextPageToken=F.when(F.col("after").isNotNull(), token(F.col("after")))),
    )
    listed = sources.ids_from_playlist_pages(responses, with_token=True)
    return flatten_chain(listed, "channelName", "pageToken", "nextPageToken", "videoIds")


@query("""
SELECT o_orderpriority AS "channelName", CAST(o_orderkey AS VARCHAR) AS "videoId",
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS position
FROM orders
""")
def json_extract_pages(spark, sf_dir):
    """Ids out of nested playlist pages, then flattened."""
    item = F.struct(
        F.struct(F.col("o_orderkey").cast("string").alias("videoId")).alias("contentDetails")
    )
    responses = order_pages(spark, sf_dir, item).select(
        "channelName", "page", response(F.col("items"))
    )
    pages = sources.ids_from_playlist_pages(responses)
    return flatten_pages(pages, "channelName", "page", "videoIds")


@query(f"""
SELECT "channelName", position // 50 AS chunk,
       string_agg(CAST("videoId" AS VARCHAR), ',' ORDER BY "videoId") AS ids
FROM ({LISTED}) GROUP BY 1, 2
""", name="chunk_ids")
def chunk_id_list(spark, sf_dir):
    orders = testbed.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("channelName"), F.col("o_orderkey").alias("videoId")
    )
    listed = positions(orders, ["channelName"], "videoId")
    return chunk_ids(listed, "channelName", "videoId")


# ---------------------------------------------------------------- reports


@query(CUR + 'SELECT "channelName", max(subscribers) AS "totalSubscribers" FROM cur GROUP BY 1')
def channel_subscribers(spark, sf_dir):
    return reports.channel_subscribers(testbed.stored(spark, sf_dir))


@query(CUR + """
SELECT "channelName", count(video_title) AS "totalVideosPublished" FROM cur GROUP BY 1
""")
def video_count(spark, sf_dir):
    return reports.video_count(testbed.stored(spark, sf_dir))


@query(CUR + """
SELECT "channelName", "year", "month", count(video_title) AS "monthlyVideosPublished"
FROM cur GROUP BY 1, 2, 3
""")
def video_trend(spark, sf_dir):
    return reports.video_trend(testbed.stored(spark, sf_dir))


@query(CUR + """
SELECT "channelName", "year", "month", count(video_title) AS "monthlyVideosPublished",
       max("viewCount") AS "maxViews"
FROM cur GROUP BY 1, 2, 3
""")
def report_by_view(spark, sf_dir):
    """A report in SQL, over a temporary view of the curated rows."""
    testbed.stored(spark, sf_dir).createOrReplaceTempView("video_data")
    return spark.sql("""
        SELECT channelName, year, month, count(video_title) AS monthlyVideosPublished,
               max(viewCount) AS maxViews
        FROM video_data GROUP BY channelName, year, month
    """)


MOST_VIEWED = CUR + """
SELECT "channelName", video_title, max("viewCount") AS "totalViews" FROM cur GROUP BY 1, 2
ORDER BY "totalViews" DESC NULLS LAST, "channelName", video_title
"""


@query(MOST_VIEWED)
def most_viewed(spark, sf_dir):
    return reports.most_viewed(testbed.stored(spark, sf_dir))


@query(MOST_VIEWED)
def landing_to_most_viewed(spark, sf_dir):
    """The whole way: documents written, read, curated into the table, and reported on."""
    zone = fresh_dir(spark, "landing")
    sinks.write_documents(testbed.documents(spark, sf_dir), zone)
    table = f"{fresh_database(spark)}.curated"
    sinks.create_curated(spark, table)
    docs = sources.read_landing(spark, zone, schemas.landing_for_curate())
    sinks.append_curated(curate(docs), table)
    return reports.most_viewed(spark.table(table))


@query(TOP_PER_CHANNEL)
def top_k_per_channel(spark, sf_dir):
    return without_zone(reports.top_videos_per_channel(testbed.stored(spark, sf_dir)))


@query(CUR + """
SELECT "channelName", video_title, "viewCount", "publishedAt" FROM cur
ORDER BY "viewCount" DESC NULLS LAST, "channelName", video_title, "publishedAt" LIMIT 5
""")
def top_k_global(spark, sf_dir):
    return without_zone(reports.top_videos(testbed.stored(spark, sf_dir)))


# ---------------------------------------------------------------- exploration


@query("SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 1000")
def row_limited_query(spark, sf_dir):
    events = testbed.table(spark, sf_dir, "events").select("event_id", "event_type")
    return explore.limited(events.orderBy("event_id"), explore.EDITOR_ROWS)


@query("SELECT least(count(*), 1000) AS n, least(count(*), 1000) AS n_known FROM events")
def sample_rows(spark, sf_dir):
    """Which rows a sample holds is open; counted are all of them and those found in the table."""
    events = testbed.table(spark, sf_dir, "events")
    sample = explore.sample_rows(events.select("event_id"))
    known = events.select("event_id", F.lit(1).alias("known"))
    return sample.join(known, "event_id", "left").agg(
        F.count("*").alias("n"), F.count("known").alias("n_known")
    )


@query("SELECT DISTINCT event_type FROM events ORDER BY 1 LIMIT 10000")
def filter_values(spark, sf_dir):
    events = testbed.table(spark, sf_dir, "events")
    return explore.filter_values(events, "event_type", explore.FILTER_SEARCH_ROWS)


@query("""
SELECT DISTINCT c_name FROM customer WHERE contains(lower(c_name), '#00000001') ORDER BY 1 LIMIT 1000
""")
def filter_values_search(spark, sf_dir):
    customers = testbed.table(spark, sf_dir, "customer")
    return explore.filter_values(customers, "c_name", explore.FILTER_ROWS, search="#00000001")


NOON = datetime(2024, 1, 30, 12)


@query("""
SELECT event_id, ts FROM events
WHERE ts >= date_trunc('day', TIMESTAMP '2024-01-30 12:00:00') - INTERVAL 7 DAY
  AND ts < date_trunc('day', TIMESTAMP '2024-01-30 12:00:00')
""")
def relative_time_filter(spark, sf_dir):
    events = testbed.table(spark, sf_dir, "events").select("event_id", "ts")
    return explore.relative_time_filter(events, "ts", NOON, days=7)


@query("""
SELECT event_id, ts FROM events
WHERE ts >= date_trunc('day', TIMESTAMP '2024-01-30 12:00:00') - INTERVAL 7 DAY
  AND ts < TIMESTAMP '2024-01-30 12:00:00'
""")
def relative_time_filter_now(spark, sf_dir):
    events = testbed.table(spark, sf_dir, "events").select("event_id", "ts")
    return explore.relative_time_filter(events, "ts", NOON, days=7, end="now")


def grain_counts(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    events = testbed.table(spark, sf_dir, "events")
    return without_zone(explore.by_time_grain(events, "ts", grain, [F.count("*").alias("n")]))


@query("SELECT date_trunc('hour', ts) AS bucket, count(*) AS n FROM events GROUP BY 1")
def time_grain(spark, sf_dir):
    return grain_counts(spark, sf_dir, "hour")


@query("""
SELECT time_bucket(INTERVAL 2 SECOND, CASE WHEN event_id % 7 <> 0 THEN ts END) AS bucket, count(*) AS n
FROM events GROUP BY 1
""")
def time_grain_custom(spark, sf_dir):
    """Rows without a time make a bucket of their own."""
    events = testbed.table(spark, sf_dir, "events")
    some = events.withColumn("ts", F.when(F.col("event_id") % 7 != 0, F.col("ts")))
    return without_zone(explore.by_time_grain(some, "ts", "2 seconds", [F.count("*").alias("n")]))


@query("""
SELECT time_bucket(INTERVAL 2 MONTH, o_orderdate, TIMESTAMP '1970-01-01') AS bucket, count(*) AS n
FROM orders GROUP BY 1
""")
def time_grain_months(spark, sf_dir):
    orders = testbed.table(spark, sf_dir, "orders")
    return without_zone(
        explore.by_time_grain(orders, "o_orderdate", "2 months", [F.count("*").alias("n")])
    )


@query(CUR + """
, m AS (SELECT "channelName", "year", count(*) AS n FROM cur GROUP BY 1, 2)
SELECT a."channelName", a."year", a.n, b.n AS prev
FROM m a LEFT JOIN m b ON a."channelName" = b."channelName" AND a."year" - 1 = b."year"
""")
def time_shift(spark, sf_dir):
    rows = testbed.curated(spark, sf_dir)
    series = rows.groupBy("channelName", "year").agg(F.count("*").alias("n"))
    return explore.time_shift(series, "year", "n", F.col("year") - 1, ["channelName"])


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 1000")
def ctas_limited(spark, sf_dir):
    table = f"{fresh_database(spark)}.result"
    orders = testbed.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    explore.ctas_limited(orders.orderBy("o_orderkey"), table, explore.EDITOR_ROWS)
    return spark.table(table)


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN NULL
                        ELSE o_orderpriority END AS priority
FROM orders
""")
def csv_with_na(spark, sf_dir):
    path = fresh_dir(spark, "upload")
    orders = testbed.table(spark, sf_dir, "orders")
    orders.select("o_orderkey", "o_orderpriority").write.csv(path, header=True, sep="\t")
    return sources.load_file(
        spark, path, "tsv", "o_orderkey BIGINT, priority STRING",
        na=[*sources.NA_STRINGS, "4-NOT SPECIFIED", "5-LOW"],
    )


@query("""
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN ''
                    ELSE ' "' || text || '", he said' END AS text, lang
FROM documents
""")
def csv_export(spark, sf_dir):
    """Text with quotes, separators, line breaks and outer spaces, empty text and NULL: out and in."""
    path = fresh_dir(spark, "export")
    quoted = F.concat(F.lit(' "'), "text", F.lit('", he said'))
    text = F.when(F.col("doc_id") % 7 == 0, "").otherwise(quoted)
    rows = testbed.table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 5 != 0, text).alias("text"), "lang"
    )
    sinks.write_csv(rows, path)
    return sources.load_file(
        spark, path, "csv", "doc_id BIGINT, text STRING, lang STRING", na=[], multiline=True
    )


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 15)
""")
def drill_to_detail(spark, sf_dir):
    orders = testbed.table(spark, sf_dir, "orders")
    cells = orders.groupBy("o_custkey").agg(F.count("*").alias("n")).filter(F.col("n") > 15)
    detail = orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return explore.drill_to_detail(detail, cells, ["o_custkey"])


@query("SELECT event_id, value FROM events WHERE event_type = 'click'")
def parameterised_sql(spark, sf_dir):
    return explore.parameterised_sql(
        spark,
        "SELECT event_id, value FROM {events} WHERE event_type = :type",
        {"type": "click"},
        events=testbed.table(spark, sf_dir, "events"),
    )


@query("""
SELECT c_custkey, c_name, c_nationkey FROM customer
WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
                      WHERE r_name = 'ASIA')
""")
def row_level_filter(spark, sf_dir):
    """A role per region, which may see the customers of the region's nations."""
    nations, regions = (testbed.table(spark, sf_dir, name) for name in ["nation", "region"])
    rules = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("role"), F.col("n_nationkey").alias("nation")
    )
    customers = testbed.table(spark, sf_dir, "customer")
    customers = customers.select("c_custkey", "c_name", "c_nationkey")
    return explore.row_level_filter(customers, rules, "ASIA", {"c_nationkey": "nation"})


@query("""
SELECT role, c_custkey, c_nationkey, c_mktsegment FROM customer, (VALUES ('clerk'), ('buyer'), ('admin')) r(role)
WHERE (role = 'admin' OR c_acctbal > 0)
  AND (role <> 'clerk' OR ((c_nationkey < 5 OR c_mktsegment = 'BUILDING') AND c_custkey % 2 = 0))
  AND (role <> 'buyer' OR c_mktsegment IN ('BUILDING', 'MACHINERY'))
""")
def row_level_rules(spark, sf_dir):
    """Rules on several columns, as three roles see the customers."""
    rows = testbed.table(spark, sf_dir, "customer")
    rules = [
        Rule("c_acctbal > 0", frozenset({"admin"}), base=True),
        Rule("c_nationkey < 5", frozenset({"clerk"}), group="where"),
        Rule("c_mktsegment = 'BUILDING'", frozenset({"clerk"}), group="where"),
        Rule("c_custkey % 2 = 0", frozenset({"clerk"}), group="which"),
        Rule("c_mktsegment IN ('BUILDING', 'MACHINERY')", frozenset({"buyer"})),
    ]
    seen = None
    for role in ["clerk", "buyer", "admin"]:
        own = visible(rows, rules, [role]).select(F.lit(role).alias("role"), "c_custkey", "c_nationkey", "c_mktsegment")
        seen = own if seen is None else seen.unionAll(own)
    return seen


@query("""
SELECT c_name AS "channelName", CAST(o_orderkey AS VARCHAR) AS "videos_videoId",
       o_orderpriority AS videos_title
FROM customer LEFT JOIN orders ON c_custkey = o_custkey
UNION ALL SELECT s_name, NULL, NULL FROM supplier
""", name="expand_nested")
def expand_nested_columns(spark, sf_dir):
    docs = landed(
        spark, sf_dir, schemas.landing(["channelName"], ["videoId", "title"]), silent=True
    )
    return expand_nested(docs)


# ---------------------------------------------------------------- training data

try:
    import corpus_pipeline
    from reelstat.llm.queries import ORACLES as LLM_ORACLES
    from reelstat.llm.queries import QUERIES as LLM_QUERIES
except ImportError:  # the subpackage has been taken out
    pass
else:
    _QUERIES.update(LLM_QUERIES)
    _ORACLES.update(LLM_ORACLES)
    _QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        _ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

# ---------------------------------------------------------------- contract

def entry(spark: SparkSession) -> DataFrame:
    """From landing documents to the most viewed videos, on the smallest data."""
    return landing_to_most_viewed(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every registered query by name."""
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query name."""
    return dict(_ORACLES)
