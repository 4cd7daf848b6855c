"""Session settings and shared folders."""

import pytest

from reelstat import session


def test_defaults(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_shared_folder_is_the_configured_one(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.fresh_dir(spark, "a") != session.fresh_dir(spark, "a")


class Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "spark://host:7077"
        applicationId = "app"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_must_name_its_folder():
    with pytest.raises(ValueError):
        session.shared_dir(Cluster)


def test_a_local_master_gets_a_folder():
    class Local(Cluster):
        class sparkContext(Cluster.sparkContext):
            master = "local[2]"
            applicationId = "local-test"

    assert session.shared_dir(Local) == session.shared_dir(Local)


def test_a_folder_set_on_the_context_is_used():
    class Prepared(Cluster):
        class sparkContext(Cluster.sparkContext):
            getCheckpointDir = staticmethod(lambda: "hdfs://name/checkpoints/")

    assert session.shared_dir(Prepared) == "hdfs://name/checkpoints"


def test_tables_of_other_catalogs_are_told_by_name(spark, conf):
    from reelstat.sinks.tables import _in_session_catalog

    conf(spark__sql__catalog__lake="org.example.Catalog")
    for name, inside in [("t", True), ("db.t", True), ("spark_catalog.db.t", True),
                         ("lake.t", False), ("lake.db.t", False)]:
        assert _in_session_catalog(spark, name) == inside


def test_written_rows_have_a_known_size(spark):
    rows = session.written(spark.range(10).filter("id > 100"), "none")
    assert rows.count() == 0 and rows.columns == ["id"]


@pytest.mark.parametrize("size, scan, shuffle", [
    (10**9, 128 << 20, 8), (10**12, 128 << 20, 3725), (100 * 10**12, 10**9, 372_529),
])
def test_partitions_follow_the_input(size, scan, shuffle):
    assert session.sized_conf(size, 8) == {
        "spark.sql.files.maxPartitionBytes": str(scan), "spark.sql.shuffle.partitions": str(shuffle),
    }


def test_partition_sizes_are_parameters():
    assert session.sized_conf(10**12, 8, largest_scan=64 << 20, per_shuffle=1 << 30) == {
        "spark.sql.files.maxPartitionBytes": str(64 << 20), "spark.sql.shuffle.partitions": "931",
    }


def test_scratch_can_be_cleared(spark):
    kept = session.shared_dir(spark) + "/other"
    spark.range(1).write.parquet(kept)
    rows = session.written(spark.range(5), "rows")
    session.removed(rows)
    with pytest.raises(Exception, match="(?i)not.exist|no such file"):
        rows.collect()
    assert spark.read.parquet(kept).count() == 1


def test_store_and_catalog_settings():
    store = session.s3a_conf("http://store:9000", "key", "secret", ssl=False)
    assert store["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert store["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    catalog = session.catalog_conf("lake", "org.example.Catalog", "http://c/api", "s3a://w", ref="main")
    assert catalog["spark.sql.catalog.lake"] == "org.apache.iceberg.spark.SparkCatalog"
    assert catalog["spark.sql.catalog.lake.ref"] == "main"
