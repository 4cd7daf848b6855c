"""Plain files: headerless CSV, and uploads in text or Parquet form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Strings that stand for a missing value in uploaded text files.
NA_STRINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Usual separator of each kind of text file.
SEPARATORS = {"csv": ",", "tsv": "\t", "txt": ","}


def read_csv_headerless(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV without a header: string columns ``_c0``, ``_c1``, …"""
    return spark.read.csv(path)


def load_file(
    spark: SparkSession,
    path: str | list[str],
    kind: str,
    schema: T.StructType | str | None = None,
    na: list[str] = NA_STRINGS,
    sep: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """An uploaded ``csv``, ``tsv``, ``txt`` or ``parquet`` file or folder.

    Text files have a header and the strings in ``na`` read as NULL. Quotes within quoted values
    are doubled. Values may hold line breaks with ``multiline``; each file is then read by one task.
    Columns are strings, or those of ``schema``, which names all of them by position. A row with
    more or fewer values than the header fails the job.
    """
    if kind == "parquet":
        return spark.read.parquet(*([path] if isinstance(path, str) else path))
    if kind not in SEPARATORS:
        raise ValueError(f"unknown kind of file: {kind!r}")
    # With an impossible string for NULL, a quoted empty value is told from one that is missing.
    text = spark.read.csv(
        path, header=True, sep=sep or SEPARATORS[kind], escape='"', multiLine=multiline,
        nullValue="\0",
        mode="FAILFAST", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    names = text.columns
    cleaned = text.select(
        *[F.when(~F.col(f"`{n}`").isin(na), F.col(f"`{n}`")).alias(n) for n in names]
    )
    if schema is None:
        return cleaned
    target = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    if len(target) != len(names):
        raise ValueError(f"the file has {len(names)} columns, the schema names {len(target)}")
    return cleaned.select(
        *[F.col(f"`{n}`").try_cast(f.dataType).alias(f.name) for n, f in zip(names, target)]
    )
