"""Sharding by histogram sort.

Rows are ordered by the checksum of their text, then by a hash of their id, so equal texts lie side
by side. Probes in that order get the exact bytes and rows below them, counted across all partitions;
cells that hold a shard boundary are probed again, more finely, until a boundary meets the tolerance.
Then the rows are exchanged once. Shards follow the law ``bytes``: their sizes are near equal. A
group of equal texts may be larger than a shard and then spans several, as its ids split it.

Defined results: a null text has no bytes and the checksum of the empty text; a null id is hashed as
a value of its own; rows equal in id and text have equal keys and stay in one shard; an empty table
gives an empty one; columns called ``shard`` and ``slot`` are replaced, others stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import map_arrow, text_bytes
from reelstat.session import written

KEY_BITS = 62
#: Bytes that every row counts beside its text.
ROW_BYTES = 16


@dataclass(frozen=True)
class Splitters:
    """Keys at which shards 1, 2, … begin, and the bytes below each."""

    keys: list[int]
    below: list[int]
    rounds: int


def size_of(text_column: str = "text") -> Column:
    return (F.length(text_bytes(text_column)) + ROW_BYTES).cast("long")


def checksum_of(text_column: str = "text") -> Column:
    return F.crc32(text_bytes(text_column))


def key_of(id_column: str, checksum: Column) -> Column:
    """32 bits of the text and 30 bits of the id."""
    return F.shiftleft(checksum, 30).bitwiseOR(F.xxhash64(id_column).bitwiseAND((1 << 30) - 1))


def histogram(sizes: DataFrame, probes: list[int]) -> np.ndarray:
    """Exact bytes of the rows (key, size) below each probe; every task adds up its own first."""
    edges = np.array(probes, dtype=np.int64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(edges) + 1, dtype=np.int64)
        for batch in batches:
            cells = np.searchsorted(edges, batch.column(0).to_numpy(), side="right")
            np.add.at(totals, cells, batch.column(1).to_numpy())
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], ["cell", "size"])

    found = sizes.select("key", "size").mapInArrow(rows, "cell long, size long")
    totals = np.zeros(len(edges) + 1, dtype=np.int64)
    for cell, size in found.groupBy("cell").agg(F.sum("size")).collect():  # at most one a probe
        totals[cell] = size
    return np.cumsum(totals)[:-1]


def find_splitters(
    sizes: DataFrame, n_shards: int, total: int, tolerance: float = 0.001, probes: int = 32
) -> Splitters:
    """Keys that cut the rows (key, size) into shards of near equal bytes.

    A boundary is settled when the cell that holds it has at most ``tolerance`` of a shard's bytes,
    or a single key; the cell's nearer end is taken. Every round makes the open cells ``probes``
    times smaller, so there are at most log(2^62) / log(probes) rounds.
    """
    goals = [total * i // n_shards for i in range(1, n_shards)]
    low = [0] * len(goals)
    high = [1 << KEY_BITS] * len(goals)
    below = {0: 0, 1 << KEY_BITS: total}
    rounds = 0

    def open_cells() -> list[int]:
        allowed = tolerance * total / n_shards
        return [
            i for i in range(len(goals))
            if high[i] - low[i] > 1 and below[high[i]] - below[low[i]] > allowed
        ]

    while still := open_cells():
        wanted = sorted({
            low[i] + (high[i] - low[i]) * k // probes for i in still for k in range(1, probes)
        } - below.keys())
        below.update(zip(wanted, map(int, histogram(sizes, wanted))))
        for i in still:
            cell = sorted(k for k in wanted if low[i] <= k <= high[i])
            low[i] = max([low[i], *(k for k in cell if below[k] <= goals[i])])
            high[i] = min([high[i], *(k for k in cell if below[k] > goals[i])])
        rounds += 1
    keys = [
        lo if goal - below[lo] <= below[hi] - goal else hi
        for goal, lo, hi in zip(goals, low, high)
    ]
    return Splitters(keys, [below[k] for k in keys], rounds)


def shard_of(key: Column, splitters: Splitters) -> Column:
    """How many splitters are at or below a key."""
    return sum((F.when(key >= k, 1).otherwise(0) for k in splitters.keys), F.lit(0)).cast("int")


def shard_documents(
    docs: DataFrame, n_shards: int, id_column: str = "doc_id", text_column: str = "text",
    tolerance: float = 0.001, measures: bool = False,
) -> DataFrame:
    """The rows with their ``shard`` and their place in it (``slot``, from 0 without gaps).

    With ``measures`` the text's ``size`` and ``text_crc32`` take the place of the text.
    """
    kept = docs.drop("shard", "slot", *["size", "text_crc32"] * measures)
    names = kept.columns
    inner = kept.toDF(*[f"_{i}" for i in range(len(names))])
    at = {name: f"_{names.index(name)}" for name in (id_column, text_column)}
    key = key_of(at[id_column], checksum_of(at[text_column]))
    sizes = written(
        inner.select(key.alias("key"), size_of(at[text_column]).alias("size")), "shard-keys"
    )
    total = sizes.agg(F.sum("size")).first()[0] or 0
    splitters = find_splitters(sizes, n_shards, total, tolerance)

    keyed = inner.withColumn("key", key).withColumn("shard", shard_of(F.col("key"), splitters))
    added = ["size", "text_crc32"] * measures
    if measures:
        text = at[text_column]
        keyed = keyed.withColumns({"size": size_of(text), "text_crc32": checksum_of(text)}).drop(text)
    order = ["shard", "key", at[id_column]]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("part", F.spark_partition_id())
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema if f.name != "key"]
    placed = written(
        dealt.drop("key").mapInArrow(_counted, ", ".join([*kinds, "place long"])), "sharded"
    )
    runs = placed.groupBy("shard", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(_window("shard", "part")) - F.col("n")
    starts = runs.select("shard", "part", (before - F.col("first")).alias("shift"))
    # One row for each pair of a partition and a shard in it: no more than partitions + shards.
    out = placed.join(F.broadcast(starts), ["shard", "part"])
    return out.select(
        *[F.col(f"_{i}").alias(name) for i, name in enumerate(names) if f"_{i}" in out.columns],
        *added, "shard", (F.col("place") + F.col("shift")).alias("slot"),
    )


def _window(by: str, order: str):
    from pyspark.sql import Window

    return Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the rows of a partition."""
    n = 0
    for batch in batches:
        places = pa.array(np.arange(n, n + batch.num_rows))
        n += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, places], [*batch.schema.names, "place"])
