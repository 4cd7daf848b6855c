"""Landing lines that tell what is wrong with them, and what no schema names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat import schemas

_CORRUPT = "_corrupt"
#: Why a line is no document.
MALFORMED, WRONG_TYPE, NAMELESS = "malformed", "wrong type", "no channel name"


def _lines(spark: SparkSession, paths: str | list[str], stream: bool) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    lines = reader.option("recursiveFileLookup", "true").text(paths)
    return lines.select("value", F.col("_metadata.file_path").alias("source")).filter(
        F.trim("value") != ""
    )


def checked_landing(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None,
    stream: bool = False,
) -> DataFrame:
    """One row for each line: source, value, doc (the document) and reason, null if nothing is wrong.

    A line is wrong if it is not JSON, if a field that the schema names has another type, or if it
    names no channel. Works on batches and streams alike.
    """
    schema = schema or schemas.landing()
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    doc = F.from_json("value", with_corrupt, {"columnNameOfCorruptRecord": _CORRUPT})
    parsed = _lines(spark, paths, stream).withColumn("doc", doc)
    reason = (
        F.when(F.try_parse_json("value").isNull(), MALFORMED)
        .when(F.col("doc").isNull() | F.col(f"doc.{_CORRUPT}").isNotNull(), WRONG_TYPE)
        .when(F.col("doc.channelName").isNull(), NAMELESS)
    )
    return parsed.withColumn("reason", reason)


def documents_of(checked: DataFrame) -> DataFrame:
    """The documents of the lines that nothing is wrong with."""
    good = checked.filter(F.col("reason").isNull())
    names = [f.name for f in checked.schema["doc"].dataType if f.name != _CORRUPT]
    return good.select(*[F.col(f"doc.{name}").alias(name) for name in names])


def quarantined(checked: DataFrame) -> DataFrame:
    """The other lines with their source and what is wrong with them."""
    return checked.filter(F.col("reason").isNotNull()).select("source", "reason", "value")


def landing_with_rest(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None,
) -> DataFrame:
    """The documents with ``rest``: a VARIANT object of the fields that the schema does not name, null
    if there are none. A field that appears in later documents is there without a rewrite of those
    before: ``variant_get(rest, '$.country', 'string')``."""
    schema = schema or schemas.landing()
    lines = _lines(spark, paths, False)
    fields = F.from_json("value", "map<string, variant>")
    other = F.map_filter(fields, lambda name, _: ~name.isin(schema.fieldNames()))
    rest = F.when(F.size(other) > 0, F.to_variant_object(other))
    docs = lines.select(F.from_json("value", schema).alias("doc"), rest.alias("rest"))
    return docs.select(*[F.col(f"doc.{name}").alias(name) for name in schema.fieldNames()], "rest")
