"""Table sinks.

Tables are Parquet tables of the session catalog; a name in another catalog uses that catalog's
own format.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from reelstat import schemas
from reelstat.session import delete_path

SESSION_CATALOG = "spark_catalog"
#: Property of a table that names the folder it had before.
PREVIOUS = "reelstat.previous"
OVERWRITE_CONF = "spark.sql.sources.partitionOverwriteMode"


def _in_session_catalog(spark: SparkSession, table: str) -> bool:
    parts = table.split(".")
    if len(parts) > 2:
        return parts[0] == SESSION_CATALOG
    other = len(parts) == 2 and spark.conf.get(f"spark.sql.catalog.{parts[0]}", None)
    return not other and spark.catalog.currentCatalog() == SESSION_CATALOG


def create_curated(
    spark: SparkSession, table: str, wide: bool = False, provider: str = "parquet"
) -> None:
    """Creates the curated table, partitioned by year and month, unless it exists."""
    columns = ", ".join(
        f"{field.name} {field.dataType.simpleString()}" for field in schemas.curated(wide)
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({columns}) USING {provider} "
        f"PARTITIONED BY ({', '.join(schemas.PARTITION_FIELDS)})",
        args={"name": table},
    )


def clustered(curated: DataFrame) -> DataFrame:
    """Rows of a partition brought together for writing; columns are taken by position.

    Rebalancing gives few files per partition and, unlike a repartition, splits a month that is
    much larger than the others over several tasks. Sorting by channel lets a reader of few
    channels skip most of each file.
    """
    named = curated.toDF(*schemas.CURATED_FIELDS)
    return named.hint("rebalance", *schemas.PARTITION_FIELDS).sortWithinPartitions(
        *schemas.PARTITION_FIELDS, "channelName"
    )


def append_curated(curated: DataFrame, table: str) -> None:
    """Appends by position; partitions follow from the rows. A rerun appends the rows again."""
    clustered(curated).write.insertInto(table)


def overwrite_partitions(curated: DataFrame, table: str) -> None:
    """Replaces the partitions that occur in the rows and keeps the others."""
    with overwriting(curated.sparkSession, "dynamic"):
        clustered(curated).write.insertInto(table, overwrite=True)


@contextmanager
def overwriting(spark: SparkSession, mode: str) -> Iterator[None]:
    """What an overwrite takes away: all partitions below the given ones, or those of the rows. A
    writer option does not reach an insert into a session catalog table."""
    before = spark.conf.get(OVERWRITE_CONF)
    spark.conf.set(OVERWRITE_CONF, mode)
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_CONF, before)


def reload_curated(curated: DataFrame, table: str) -> None:
    """Empties the table and inserts the rows, which must not be read from the same table.

    The two steps are separate commits: a reader can meet the empty table.
    """
    curated.sparkSession.sql("TRUNCATE TABLE IDENTIFIER(:name)", args={"name": table})
    append_curated(curated, table)


def append_table(df: DataFrame, table: str) -> None:
    """Appends to a table by column name, creating it on first use."""
    if _in_session_catalog(df.sparkSession, table):
        df.write.mode("append").format("parquet").saveAsTable(table)
    elif df.sparkSession.catalog.tableExists(table):
        df.writeTo(table).append()
    else:
        df.writeTo(table).create()


def replace_table(df: DataFrame, table: str) -> None:
    """Puts the rows in place of the table, creating it on first use.

    In the session catalog every version has a folder of its own. The rows are written to a new one
    first, then a single statement points the table to it, then the old folder goes: a job that
    fails at any time leaves either the old rows or the new ones, no file is moved, and the rows may
    come from the table itself. The folder before stays until the next replacement, for queries that
    are still reading it. Only where the columns change, the table is dropped and made anew,
    and a reader can meet a gap. Catalogs with atomic replacement are used as such.
    """
    spark = df.sparkSession
    if not _in_session_catalog(spark, table):
        df.writeTo(table).createOrReplace()
        return
    if not spark.catalog.tableExists(table):
        df.write.format("parquet").saveAsTable(table)
        return
    old = location_of(spark, table)
    new = f"{old.rpartition('/')[0]}/{table.rpartition('.')[2]}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(new)
        _switch(spark, df, table, new)
    except Exception:
        if location_of(spark, table) != new:
            delete_path(spark, new)
        raise
    _keep_one(spark, table, old)


def _keep_one(spark: SparkSession, table: str, old: str) -> None:
    """Notes the folder that was replaced and deletes the one noted before."""
    name = ".".join(f"`{part}`" for part in table.split("."))
    known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    place = old.replace("'", r"\'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PREVIOUS}' = '{place}')")
    if PREVIOUS in known:
        delete_path(spark, known[PREVIOUS])


def location_of(spark: SparkSession, table: str) -> str:
    rows = spark.sql("DESCRIBE EXTENDED IDENTIFIER(:name)", args={"name": table}).collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location").rstrip("/")


def _switch(spark: SparkSession, df: DataFrame, table: str, location: str) -> None:
    """Points a table to other files."""
    place = location.replace("'", r"\'")
    name = ".".join(f"`{part}`" for part in table.split("."))
    same = [(f.name, f.dataType) for f in spark.table(table).schema] == [
        (f.name, f.dataType) for f in df.schema
    ]
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
    else:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{place}'")
    spark.catalog.refreshTable(table)
