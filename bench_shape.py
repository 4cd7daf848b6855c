"""Times one day's work in two shapes on the same landed documents and prints one JSON line.

``loop`` is the plain shape: for each channel a read with inferred schema and an insert of its own,
then four reports that each read the whole curated table. ``one_job`` is what this library does.
The documents are one line per channel, the channel being the order priority. Uses the settings
of ``bench.py``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import functions as F

from reelstat import jobs, schemas, sinks, testbed
from reelstat.operators import assemble_documents
from reelstat.plans import reports
from reelstat.plans.curate import curate
from reelstat.session import build_session, clear_scratch, fresh_database, fresh_dir


def land(spark, sf_dir: str) -> str:
    videos = testbed.videos(spark, sf_dir).drop("c_custkey")
    videos = videos.withColumn("channelName", F.col("title"))
    channels = videos.groupBy("channelName").agg(
        F.lit("10").alias("subscribers"),
        F.sum(F.col("viewCount").cast("bigint")).cast("string").alias("views"),
        F.count("*").cast("string").alias("totalVideos"),
        F.lit("PL").alias("playlistId"),
    )
    documents = assemble_documents(channels, videos, "channelName", max_items=10**9)
    path = fresh_dir(spark, "landing")
    sinks.write_documents(documents.select(schemas.landing().fieldNames()), path, by_channel=True)
    return path


def loop(spark, zone: str, folders: list[str]) -> str:
    database = fresh_database(spark)
    table = f"{database}.curated"
    sinks.create_curated(spark, table)
    for folder in folders:
        curate(spark.read.json(folder)).write.insertInto(table)
    curated = spark.table(table)
    for name, report in [
        ("channel_subscribers", reports.channel_subscribers(curated)),
        ("video_count", reports.video_count(curated)),
        ("video_trend", reports.video_trend(curated)),
        ("most_viewed_videos", reports.most_viewed(curated)),
    ]:
        sinks.replace_table(report, f"{database}.{name}")
    return database


def one_job(spark, zone: str, folders: list[str]) -> str:
    database = fresh_database(spark)
    jobs.run_curate(spark, [zone], f"{database}.curated")
    jobs.run_report(spark, f"{database}.curated", f"{database}.")
    return database


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "reelstat-shape",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="reelstat-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    zone = land(spark, sf_dir)
    folders = [
        row.folder
        for row in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(zone)
        .filter(F.col("path").contains("channel="))
        .select(F.substring_index("path", "/part-", 1).alias("folder")).distinct().collect()
    ]
    seconds, totals = {}, {}
    for name, shape in [("loop", loop), ("one_job", one_job)]:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            database = shape(spark, zone, folders)
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        totals[name] = sorted(map(tuple, spark.table(f"{database}.video_count").collect()))
        print(f"{name}: {seconds[name]:.2f} s", file=sys.stderr)
    assert totals["loop"] == totals["one_job"]
    print(json.dumps({"metric": "day_time", "unit": "sec", **seconds, "channels": len(folders)}))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
