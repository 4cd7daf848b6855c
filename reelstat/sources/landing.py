"""The landing zone: JSON lines, one channel document per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat import schemas


# Characters that Spark escapes in the names of partition folders.
_ESCAPED = "\"#%'*/:=?\\{[]^"


def read_landing(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType | None = None,
    with_source: bool = False,
) -> DataFrame:
    """Documents of one or many paths, folders or globs, read by a single job.

    The schema is always given: inferring it costs a pass over the data, and a document whose
    ``videos`` array is empty would be inferred as an array of strings. Missing fields read as
    NULL. ``with_source`` adds the file each document came from.
    """
    docs = (
        spark.read.schema(schema or schemas.landing())
        .option("recursiveFileLookup", "true")
        .json(paths)
    )
    return docs.withColumn("source", F.col("_metadata.file_path")) if with_source else docs


def channel_paths(root: str, names: list[str]) -> list[str]:
    """Folders of the named channels in a landing zone that is written by channel. Only these are
    listed and read."""
    folders = [_escaped(name.replace(" ", "_")) for name in names]
    return [f"{root.rstrip('/')}/channel={folder}" for folder in folders]


def _escaped(value: str) -> str:
    """A value as Spark writes it into the name of a partition's folder."""
    return "".join(
        f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 or ord(c) == 127 else c for c in value
    )


def of_channels(df: DataFrame, names: list[str], column: str = "channelName") -> DataFrame:
    """Rows of the named channels. The predicate reaches the scan."""
    return df.filter(F.col(column).isin(names))


def landing_manifest(
    spark: SparkSession, path: str | list[str], with_uri: bool = False
) -> DataFrame:
    """Path, size and time of every landed file. File contents are not read. ``with_uri`` adds the
    path as other readers give it in ``_metadata.file_path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    columns = [*(F.col(x) for x in ("path", "length", "modificationTime"))]
    return files.select(*columns, *([F.col("_metadata.file_path").alias("uri")] if with_uri else []))
