"""Joins whose large side may be skewed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def match(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Joins a side that may have hot keys with one derived by grouping or joining on them.

    NULL keys match NULL keys. The null-safe comparison also makes Spark shuffle both sides right
    below the join, where a plain one would reuse the partitioning the right side already has.
    That costs a shuffle of the small side, and is what adaptive execution needs: it then knows
    that side's real size, broadcasts it if it is below the session's threshold, and otherwise
    splits the hot keys of the left side.
    """
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    return left.join(renamed, condition, how).drop(*[f"_right_{key}" for key in keys])


def having_keys(df: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose keys occur in ``chosen``."""
    return match(df, chosen.select(*keys), keys, "left_semi")
