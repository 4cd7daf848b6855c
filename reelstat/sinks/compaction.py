"""Few files in place of many, partition by partition, in a Parquet table of the session catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat import schemas
from reelstat.session import delete_path
from reelstat.sinks.tables import clustered, location_of

#: Size of a file that is large enough.
TARGET = 128 << 20


def files_of(spark: SparkSession, table: str) -> DataFrame:
    """Files and bytes of each month."""
    meta = F.col("_metadata")
    files = spark.table(table).select(
        *schemas.PARTITION_FIELDS, meta["file_path"].alias("file"), meta["file_size"].alias("size")
    ).groupBy(*schemas.PARTITION_FIELDS, "file").agg(F.max("size").alias("size"), F.count("*").alias("rows"))
    return files.groupBy(*schemas.PARTITION_FIELDS).agg(
        F.count("*").alias("files"), F.sum("size").alias("bytes"), F.sum("rows").alias("rows"),
        F.sum(F.xxhash64("file").cast("decimal(38,0)")).alias("mark"),
    )


def compact_table(spark: SparkSession, table: str, target: int = TARGET, least: int = 2) -> int:
    """Rewrites the months that have at least ``least`` times the files that their bytes need; returns
    their number.

    The rows are written to folders of their own, all months in one job, and each month is then
    switched to its new folder by a statement, unless files were added to it meanwhile. Until then
    readers see the old files. The files of the months that were switched are deleted at the end, so
    run it when no report is reading.
    """
    before = files_of(spark, table).collect()  # a row for each month
    chosen = [r for r in before if r["files"] >= max(least * -(-r["bytes"] // target), 2)]
    if not chosen:
        return 0
    months = spark.createDataFrame(
        [tuple(r[name] for name in schemas.PARTITION_FIELDS) for r in chosen], "year int, month int"
    )
    rows = spark.table(table)
    same = [rows[name].eqNullSafe(months[name]) for name in schemas.PARTITION_FIELDS]
    root = location_of(spark, table)
    new = f"{root.rpartition('/')[0]}/{table.rpartition('.')[2]}-{uuid.uuid4().hex}"
    clustered(rows.join(months, same, "left_semi")).write.partitionBy(*schemas.PARTITION_FIELDS).parquet(new)
    now = {tuple(r)[:2]: r["mark"] for r in files_of(spark, table).collect()}
    name = ".".join(f"`{part}`" for part in table.split("."))
    switched = 0
    for r in chosen:
        if now.get(tuple(r)[:2]) != r["mark"]:
            continue
        values = [r[field] for field in schemas.PARTITION_FIELDS]
        spec = ", ".join(
            f"{field} = {'null' if value is None else value}" for field, value in zip(schemas.PARTITION_FIELDS, values)
        )
        folder = "/".join(
            f"{field}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
            for field, value in zip(schemas.PARTITION_FIELDS, values)
        )
        old = next(
            x["data_type"] for x in spark.sql(f"DESCRIBE EXTENDED {name} PARTITION ({spec})").collect()
            if x["col_name"] == "Location"
        )
        place = f"{new}/{folder}".replace("'", r"\'")
        spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{place}'")
        delete_path(spark, old)
        switched += 1
    spark.catalog.refreshTable(table)
    return switched
