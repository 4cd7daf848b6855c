"""Documents that replace each other under a key, as objects of a store do.

Every landing appends a version; nothing is rewritten while it lands. Documents lie by bucket of their
key and by version, so a version that is landed again replaces itself, and what is out of date can be
rewritten bucket by bucket. The current document of a key is the one of its largest version; a key's
documents of one version belong together, such as the parts of a large one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat.operators.joins import match
from reelstat.session import delete_path, removed, written

BUCKETS = 64


def land_version(docs: DataFrame, path: str, key: str, version: int, buckets: int = BUCKETS) -> None:
    """Adds the documents as a version of their keys, or puts them in place of the same version."""
    placed = docs.withColumn("version", F.lit(version).cast("bigint")).withColumn(
        "bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    )
    _overwrite(placed, path)


def _overwrite(placed: DataFrame, path: str) -> None:
    writer = placed.hint("rebalance", "bucket").write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version").parquet(path)


def _versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    kinds = T.StructType([*schema.fields]).add("bucket", T.IntegerType()).add("version", T.LongType())
    return spark.read.schema(kinds).parquet(path)


def current_documents(
    spark: SparkSession, path: str, schema: T.StructType, key: str, keys: list | None = None
) -> DataFrame:
    """The documents of each key's largest version, or those of some ``keys`` only."""
    rows = _versions(spark, path, schema)
    if keys is not None:
        rows = rows.filter(F.col(key).isin(keys))
    return _current(rows, key).select(*schema.fieldNames())


def _current(rows: DataFrame, key: str) -> DataFrame:
    # Two columns are read for this, and one row a key leaves each task.
    latest = rows.groupBy("bucket", key).agg(F.max("version").alias("version"))
    return match(rows, latest, ["bucket", key, "version"], "left_semi")


def compact_versions(spark: SparkSession, path: str, schema: T.StructType, key: str) -> int:
    """Rewrites the folders that hold documents out of date, without these; returns how many there
    were. Current documents stay where they are, so readers see the same before, meanwhile and after,
    and a compaction that fails can be repeated."""
    rows = _versions(spark, path, schema)
    latest = rows.groupBy("bucket", key).agg(F.max("version").alias("_last"))
    folders = match(rows.select("bucket", key, "version"), latest, ["bucket", key]).groupBy(
        "bucket", "version"
    ).agg(
        F.count(F.when(F.col("version") < F.col("_last"), 1)).alias("stale"), F.count("*").alias("all")
    ).filter("stale > 0").collect()  # a row for each folder at most
    mixed = [(r["bucket"], r["version"]) for r in folders if r["stale"] < r["all"]]
    if mixed:
        chosen = spark.createDataFrame(mixed, "bucket int, version bigint")
        kept = written(match(_current(rows, key), chosen, ["bucket", "version"], "left_semi"), "versions")
        _overwrite(kept, path)
        removed(kept)
    for r in folders:
        if r["stale"] == r["all"]:
            delete_path(spark, f"{path}/bucket={r['bucket']}/version={r['version']}")
    return sum(r["stale"] for r in folders)
