"""Landing zone to the curated rows, every version of a landed file once."""

from __future__ import annotations

import re
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat import schemas
from reelstat.plans.curate import curate
from reelstat.sinks.batches import create_batches, overwrite_batch, show_batches
from reelstat.sources.checked import checked_landing, documents_of, quarantined
from reelstat.sources.landing import landing_manifest, read_landing

#: What tells a version of a landed file.
IDENTITY = ["path", "length", "modified"]
LOG_SCHEMA = "path STRING, length BIGINT, modified BIGINT, checksum STRING, read_at BIGINT"
#: A file that changed so many milliseconds before it was read, or later, may have changed again
#: without another time to tell.
TICK = 2_000
#: Attempts at a batch whose files change while they are read.
ATTEMPTS = 5


def ingest_landing(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    archive: str | None = None,
    delete: bool = False,
    files_per_batch: int = 100_000,
    wide: bool = False,
    quarantine: str | None = None,
) -> int:
    """Curates the files that landed since the last run; returns how many batches that took.

    ``table`` becomes a view of the committed rows, whose files lie in the table ``<table>_batches``,
    partitioned by batch and month. A batch's rows replace whatever an earlier attempt at the same
    batch has left, are written by the executors to where they stay, and are seen once the batch is
    in the log below ``checkpoint``. So a run may fail anywhere and be repeated.

    The log tells files by path, length, time and, where the time may be too coarse, checksum: a file
    that lands again under its old name is read again. With ``archive``, the documents of each batch
    are copied there, compressed; with it or with ``delete``, the files that the log holds leave the landing zone,
    but not those that have changed since. With ``quarantine``, lines that are no documents go there
    with their file and what is wrong with them, batch by batch as well. Files without a byte are no versions and stay.
    """
    if archive and f"{archive.rstrip('/')}/".startswith(f"{landing.rstrip('/')}/"):
        raise ValueError("the archive would be read as part of the landing zone")
    log = f"{checkpoint.rstrip('/')}/log"
    spark.createDataFrame([], LOG_SCHEMA).write.mode("ignore").parquet(f"{log}/batch=-1")
    create_batches(spark, table, wide)
    number = first = _last_batch(spark, log) + 1
    show_batches(spark, table, number - 1)
    while files := _unread(spark, landing, log).orderBy("modified", "path").limit(files_per_batch).collect():
        read = _batch(spark, files, table, number, archive, wide, quarantine)
        # One file, so the batch is in the log at once or not at all.
        read.coalesce(1).write.mode("overwrite").parquet(f"{log}/batch={number}")
        show_batches(spark, table, number)
        number += 1
        if len(files) < files_per_batch:
            break
    if archive or delete:
        _delete_read(spark, landing, log)
    return number - first


def file_log(spark: SparkSession, log: str) -> DataFrame:
    """The versions of files that were read, with the batch of each."""
    return spark.read.schema(f"{LOG_SCHEMA}, batch BIGINT").parquet(log)


def committed(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that is committed, -1 before the first."""
    return _last_batch(spark, f"{checkpoint.rstrip('/')}/log")


def _last_batch(spark: SparkSession, log: str) -> int:
    last = file_log(spark, log).agg(F.max("batch")).first()[0]
    return -1 if last is None else last


def _listed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return landing_manifest(spark, paths).select(
        "path", "length", F.unix_millis("modificationTime").alias("modified")
    )


def _unread(spark: SparkSession, landing: str, log: str) -> DataFrame:
    """Versions of landed files that the log does not hold."""
    known = file_log(spark, log).groupBy(*IDENTITY).agg(
        F.max_by("checksum", "batch").alias("checksum"), F.max("read_at").alias("read_at")
    )
    listed = _listed(spark, landing).join(known, IDENTITY, "left")
    unread = listed.filter(F.col("read_at").isNull()).select(*IDENTITY)
    doubtful = listed.filter(F.col("modified") > F.col("read_at") - TICK)
    paths = [row["path"] for row in doubtful.select("path").collect()]
    if not paths:
        return unread
    changed = doubtful.join(_checksums(spark, paths).withColumnRenamed("checksum", "now"), "path")
    return unread.unionAll(changed.filter("checksum <> now").select(*IDENTITY))


def _literal(path: str) -> str:
    """A path without the meaning that some characters have in a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _checksums(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A checksum of the lines of each file, which does not depend on how the file is split."""
    plain = [_literal(path) for path in paths]
    lines = spark.read.text(plain).select(F.col("_metadata.file_path").alias("uri"), "value")
    sums = lines.groupBy("uri").agg(
        F.sum(F.xxhash64("value").cast("decimal(38,0)")).cast("string").alias("checksum")
    )
    # The manifest knows both forms of a path.
    names = landing_manifest(spark, plain, with_uri=True).select("path", "uri")
    return names.join(sums, "uri", "left").select("path", F.coalesce("checksum", F.lit("")).alias("checksum"))


def _batch(
    spark: SparkSession, files: list, table: str, number: int, archive: str | None, wide: bool,
    quarantine: str | None,
) -> DataFrame:
    """Writes the rows of the files, and returns what the log is to hold of them."""
    paths = [row["path"] for row in files]
    plain = [_literal(path) for path in paths]
    for _ in range(ATTEMPTS):
        wanted = {tuple(row[name] for name in IDENTITY) for row in files}
        read_at = int(time.time() * 1000)
        if quarantine:
            lines = checked_landing(spark, plain, schemas.landing_for_curate())
            bad = quarantined(lines)
            bad.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch={number}")
            docs = documents_of(lines)
        else:
            docs = read_landing(spark, plain, schemas.landing_for_curate())
        overwrite_batch(curate(docs, wide), table, number)
        if archive:
            # One file for each scan task, so none is too large to be read again by one task.
            lines = spark.read.text(plain).write.mode("overwrite").option("compression", "gzip")
            lines.text(f"{archive.rstrip('/')}/batch={number}")
        sums = _checksums(spark, paths)
        seen = _listed(spark, plain).join(sums, "path").withColumn("read_at", F.lit(read_at)).collect()
        # As many rows as the batch has files. What has changed meanwhile is read again.
        if {tuple(row[name] for name in IDENTITY) for row in seen} == wanted:
            return spark.createDataFrame(seen, LOG_SCHEMA)
        files = seen
    raise OSError(f"files of batch {number} keep changing while they are read")


def _delete_read(spark: SparkSession, landing: str, log: str, at_once: int = 32) -> None:
    """Deletes the files whose present version is in the log. Deleting is a call to the store for
    each file; ``at_once`` of them run at a time."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def delete(row) -> None:
        path = jvm.org.apache.hadoop.fs.Path(row["path"])
        system = path.getFileSystem(conf)
        if system.exists(path):
            status = system.getFileStatus(path)
            if (status.getLen(), status.getModificationTime()) == (row["length"], row["modified"]):
                system.delete(path, False)

    read = _listed(spark, landing).join(file_log(spark, log).select(*IDENTITY).distinct(), IDENTITY)
    unread = _unread(spark, landing, log)
    with ThreadPoolExecutor(at_once) as pool:
        for _ in pool.map(delete, read.join(unread, IDENTITY, "left_anti").toLocalIterator()):
            pass

