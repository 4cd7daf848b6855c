"""Running totals and positions within keys, without one task per key.

A window over a key puts all rows of that key into one task. Here rows are windowed per
(key, block), a block being a run of ``block`` consecutive values of the integer column that
orders them, and each block starts from the total of the blocks before it. Those totals come from
a pre-aggregation with one row per (key, block), to which the same step is applied again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows of a key that one task puts in order. With two levels, the last one then has at most
# 2 ** 23 rows per key even if the order column spreads over all 64-bit integers.
BLOCK = 1 << 20


def running_total(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: str,
    out: str,
    block: int = BLOCK,
    levels: int = 2,
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same keys that come before.

    ``order`` must be an integer column that is unique within the keys. A window task then sees
    at most ``block`` rows of one key, and the last level at most
    ``range(order) / block ** levels`` rows.
    """
    before = (Window.unboundedPreceding, -1)
    if levels == 0:
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(*before)
        return df.withColumn(out, F.coalesce(F.sum(value).over(window), F.lit(0)))

    number, head = f"_block{levels}", f"_head{levels}"
    blocked = df.withColumn(number, F.expr(f"`{order}` div {int(block)}"))
    totals = blocked.groupBy(*keys, number).agg(F.sum(value).alias(value))
    starts = running_total(totals, keys, number, value, out, block, levels - 1)
    # Each block gets one head row that carries its start and sorts first: a single shuffle
    # brings starts and rows together, and NULL keys meet as they do in any grouping.
    heads = starts.select(*keys, number, F.col(out).alias(value), F.lit(True).alias(head))
    rows = blocked.withColumn(head, F.lit(False)).unionByName(heads, allowMissingColumns=True)
    window = (
        Window.partitionBy(*keys, number).orderBy(F.desc(head), order).rowsBetween(*before)
    )
    return rows.withColumn(out, F.sum(value).over(window)).filter(~F.col(head)).drop(number, head)


def positions(
    df: DataFrame, keys: list[str], order: str, out: str = "position", block: int = BLOCK
) -> DataFrame:
    """Adds the zero-based position of each row within its keys."""
    counted = df.withColumn("_one", F.lit(1).cast("bigint"))
    return running_total(counted, keys, order, "_one", out, block).drop("_one")
