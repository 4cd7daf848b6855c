"""Spark session set-up: defaults, object store and catalog wiring, shared scratch space."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    # year() and month() follow the session zone, so it is never left to the machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Size of a shuffle read task, and of the files a rebalanced write leaves behind.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Unlike the default form, this one lets Parquet skip row groups by time.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "reelstat", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the defaults above; ``conf`` is applied last and wins."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_conf(
    input_bytes: int, cores: int, largest_scan: int = 1 << 30, per_shuffle: int = 256 << 20
) -> dict[str, str]:
    """Partition settings for a job that reads about ``input_bytes``.

    Scan tasks grow from 128 MB to ``largest_scan`` so that their number stays manageable. Shuffles
    start with one partition for ``per_shuffle`` bytes of input, which adaptive execution then
    merges to what the shuffled data really needs; it cannot make too few partitions of an
    aggregation smaller.
    """
    scan = min(max(input_bytes // 100_000, 128 << 20), largest_scan)
    shuffle = max(input_bytes // per_shuffle, cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.shuffle.partitions": str(shuffle),
    }


def s3a_conf(
    endpoint: str, access_key: str, secret_key: str, ssl: bool = True, path_style: bool = True
) -> dict[str, str]:
    """Settings that let ``s3a://`` paths reach an S3-compatible store."""
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
    }


def catalog_conf(
    name: str, catalog_impl: str, uri: str, warehouse: str, **options: str
) -> dict[str, str]:
    """Settings for an Iceberg catalog called ``name`` (its jars must be on the class path)."""
    prefix = f"spark.sql.catalog.{name}"
    settings = {
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.catalog-impl": catalog_impl,
        f"{prefix}.uri": uri,
        f"{prefix}.warehouse": warehouse,
    }
    settings.update({f"{prefix}.{key}": value for key, value in options.items()})
    return settings


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may do without the setting; it gets a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = made = tempfile.mkdtemp(prefix="reelstat-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
    return _local_dirs[context.applicationId]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_dir(spark: SparkSession) -> str:
    """Where this application keeps what it writes for itself."""
    return f"{shared_dir(spark)}/reelstat/{spark.sparkContext.applicationId}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder wherever it is, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def removed(df: DataFrame) -> None:
    """Deletes the files of a table that ``written`` made; nothing may read it any more."""
    for folder in {path.rpartition("/")[0] for path in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes all that this application has written for itself."""
    delete_path(spark, scratch_dir(spark))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written below the shared folder and read back: their lineage ends there and
    their size is known to the planner."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def fresh_database(spark: SparkSession) -> str:
    """A new database whose managed tables live below the shared folder; returns its name."""
    name = f"reelstat_{uuid.uuid4().hex}"
    location = f"{scratch_dir(spark)}/{name}".replace("'", r"\'")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")
    return name
