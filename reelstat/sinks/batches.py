"""Curated rows in numbered batches, each of which is written, and seen, as a whole.

The rows lie in a table partitioned by batch, year and month. A view of the caller's name shows the
batches up to the last committed one, without the number; replacing the view is what commits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelstat import schemas
from reelstat.sinks.tables import clustered, overwriting

#: The batch of rows that come from elsewhere; it is always seen.
OTHERS = -1


def batches_of(table: str) -> str:
    """The table behind a view."""
    return f"{table}_batches"


def create_batches(spark: SparkSession, table: str, wide: bool = False) -> None:
    """Creates the table of batches and its view, unless they exist."""
    if spark.catalog.tableExists(table) and not spark.catalog.tableExists(batches_of(table)):
        raise ValueError(f"{table} is a table; batches need a view of that name")
    columns = ", ".join(
        f"{field.name} {field.dataType.simpleString()}" for field in schemas.curated(wide)
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({columns}, batch BIGINT) USING parquet "
        f"PARTITIONED BY (batch, {', '.join(schemas.PARTITION_FIELDS)})",
        args={"name": batches_of(table)},
    )
    if not spark.catalog.tableExists(table):
        show_batches(spark, table, OTHERS)


def overwrite_batch(curated: DataFrame, table: str, number: int) -> None:
    """Puts rows in place of all that the batch holds, whatever months it had."""
    # With a fixed batch a static overwrite takes away all of its months, not only those of the rows.
    with overwriting(curated.sparkSession, "static"):
        _insert(curated, table, number, "OVERWRITE")


def append_rows(curated: DataFrame, table: str) -> None:
    """Adds rows that come from elsewhere. A rerun adds them again."""
    _insert(curated, table, OTHERS, "INTO")


def _insert(curated: DataFrame, table: str, number: int, how: str) -> None:
    spark = curated.sparkSession
    months = ", ".join(schemas.PARTITION_FIELDS)
    spark.sql(
        f"INSERT {how} TABLE {_quoted(batches_of(table))} PARTITION (batch = {int(number)}, {months}) "
        "SELECT * FROM {rows}",
        rows=clustered(curated),
    )


def show_batches(spark: SparkSession, table: str, last: int) -> None:
    """Lets the view show the batches up to ``last``, in one statement."""
    fields = ", ".join(schemas.CURATED_FIELDS)
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(table)} AS "
        f"SELECT {fields} FROM {_quoted(batches_of(table))} WHERE batch <= {int(last)}"
    )


def _quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))
