"""Names built from a channel's title."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ending of a landing object's name.
RAW_SUFFIX = "_raw_data.json"


def safe_name(name: Column) -> Column:
    """Spaces become underscores."""
    return F.replace(name, F.lit(" "), F.lit("_"))


def object_key(folder: Column, name: Column) -> Column:
    """Key of a landing object: folder, slash, file name."""
    return F.concat(safe_name(folder), F.lit("/"), safe_name(name), F.lit(RAW_SUFFIX))


def derived_table(name: Column, kind: str, catalog: str = "") -> Column:
    """Name of a table derived from one channel, such as ``<channel>_trend_data``."""
    prefix = f"{catalog}." if catalog else ""
    return F.concat(F.lit(prefix), safe_name(name), F.lit(f"_{kind}"))
