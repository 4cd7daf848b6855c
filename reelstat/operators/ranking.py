"""Top-k, overall and per key. The order given must be total, so that ties have one outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"
SALTS = 256


def top_k_per(
    df: DataFrame, keys: list[str], order: list[Column], k: int = 5, out: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each key, numbered from 1.

    Spark cuts each key to ``k`` rows before the shuffle, so a hot key costs ``k`` rows per task.
    It does so up to a threshold of the session. Above it each key is dealt out over ``SALTS`` tasks
    by a hash of the row, each cuts its part to ``k`` rows, and only these meet.
    """
    threshold = int(df.sparkSession.conf.get(LIMIT_CONF, "1000"))
    if k > threshold:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        own = Window.partitionBy(*keys, "_salt").orderBy(*order)
        first = salted.withColumn("_own", F.row_number().over(own)).filter(F.col("_own") <= k)
        df = first.drop("_salt", "_own")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window)).filter(F.col(out) <= k)


def top_k(df: DataFrame, order: list[Column], k: int = 5) -> DataFrame:
    """The first ``k`` rows overall: each task keeps ``k`` rows, no full sort."""
    return df.orderBy(*order).limit(k)
