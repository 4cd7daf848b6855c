"""Nested columns to rows and flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def explode_videos(docs: DataFrame) -> DataFrame:
    """One row per video, as struct column ``video``; a channel without videos gives no row."""
    parent = [name for name in docs.columns if name != "videos"]
    return docs.select(*parent, F.explode("videos").alias("video"))


def expand_nested(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every array to rows and every struct to columns, named ``outer<sep>inner``.

    A row whose array is empty or NULL stays, with NULLs. Two arrays side by side would multiply
    each other's rows, so a second array at the same level is refused, and so are names that would
    occur twice.
    """
    while True:
        fields = df.schema.fields
        arrays = [f.name for f in fields if isinstance(f.dataType, T.ArrayType)]
        structs = [f.name for f in fields if isinstance(f.dataType, T.StructType)]
        if not arrays and not structs:
            return df
        if len(arrays) > 1:
            raise ValueError(f"cannot expand more than one array at a time: {arrays}")
        columns = []
        for field in fields:
            column = F.col(f"`{field.name}`")
            if field.name in arrays:
                columns.append(F.explode_outer(column).alias(field.name))
            elif field.name in structs:
                columns += [
                    column[inner].alias(f"{field.name}{sep}{inner}")
                    for inner in field.dataType.fieldNames()
                ]
            else:
                columns.append(column)
        df = df.select(*columns)
        twice = {name for name in df.columns if df.columns.count(name) > 1}
        if twice:
            raise ValueError(f"names would occur twice: {sorted(twice)}")
