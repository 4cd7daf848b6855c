"""The jobs, as a scheduler would call them."""

import pytest

from reelstat import jobs, schemas, sinks, sources, testbed


@pytest.fixture
def zone(spark, sf_dir, folder):
    path = folder("landing")
    sinks.write_documents(testbed.documents(spark, sf_dir, silent=True), path)
    return path


def test_curate_then_report(spark, zone, database):
    table = f"{database}.curated"
    jobs.main(["curate", "--landing", zone, "--table", table])
    n = spark.table(table).count()
    assert n > 0 and spark.table(table).schema == schemas.curated()
    jobs.main(["curate", "--landing", zone, "--table", table])
    assert spark.table(table).count() == 2 * n
    jobs.main(["curate", "--landing", zone, "--table", table, "--mode", "partitions"])
    assert spark.table(table).count() == n
    jobs.main(["curate", "--landing", zone, "--table", table, "--mode", "reload"])
    assert spark.table(table).count() == n
    jobs.main(["report", "--table", table, "--prefix", f"{database}.daily_"])
    assert {t.name for t in spark.catalog.listTables(database) if not t.isTemporary} == {
        "curated", "daily_channel_subscribers", "daily_video_count", "daily_video_trend",
        "daily_most_viewed_videos",
    }


def test_several_landing_paths_and_wide_counts(spark, zone, database):
    table = f"{database}.curated"
    jobs.main(["curate", "--landing", zone, zone + "/part-*", "--table", table, "--wide"])
    assert dict(spark.table(table).dtypes)["viewCount"] == "bigint"


def test_ingest_then_report(spark, zone, folder, database):
    table = f"{database}.curated"
    arguments = ["ingest", "--landing", zone, "--table", table, "--checkpoint", folder("checkpoint")]
    jobs.main(arguments)
    n = spark.table(table).count()
    jobs.main([*arguments, "--delete"])
    assert spark.table(table).count() == n > 0
    jobs.main(["report", "--table", table, "--prefix", f"{database}.daily_"])
    titled = spark.table(f"{database}.daily_video_count").agg({"totalVideosPublished": "sum"}).first()[0]
    assert titled == n
    assert sources.read_landing(spark, zone).count() == 0


def test_settings_are_passed(spark, zone, folder, database):
    jobs.main(["--conf", "spark.sql.files.maxPartitionBytes=64m", "ingest", "--landing", zone,
               "--table", f"{database}.a", "--checkpoint", folder("b")])
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "64m"
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
