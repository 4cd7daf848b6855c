"""All pairs of similar sets within given groups, by pairs of blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Elements that the sets of a block have about, and columns of a matrix at a time.
BLOCK, COLUMNS = 1 << 18, 1 << 12
#: Sets of either side that are multiplied together.
ROWS = 512


def linked_in_blocks(sets: DataFrame, percent: int, pairs: bool = False) -> DataFrame:
    """The links within the components of ``sets`` (component, key, doc_id, n, own, copies).

    With ``pairs`` a row for each link: (a, b, common), the smaller doc_id first; else (key, linked):
    the sum of ``copies`` over the sets that are linked with a key. A set comes to as many tasks as
    its component has blocks, which is one unless a component is large.
    """
    sizes = sets.groupBy("component").agg(F.ceil(F.sum("n") / BLOCK).cast("long").alias("blocks"))
    dealt = sets.join(sizes, "component").withColumn("own_block", F.pmod(F.xxhash64("key"), "blocks"))
    spread = dealt.select(
        "component", "key", "doc_id", "own", "copies", "own_block",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"),
    ).select(
        "component", F.least("own_block", "other").alias("low"), F.greatest("own_block", "other").alias("high"),
        (F.col("own_block") > F.col("other")).alias("right"), "key", "doc_id", "own", "copies",
    )
    tasks = ["component", "low", "high"]
    near = spread.repartition(*tasks).sortWithinPartitions(*tasks)
    kind = sets.schema["doc_id"].dataType.simpleString()
    schema = f"a {kind}, b {kind}, common long" if pairs else "key long, linked long"
    names = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            yield from _links(group, percent, pairs, names)

    found = near.mapInArrow(run, schema)
    return found if pairs else found.groupBy("key").agg(F.sum("linked").alias("linked"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each pair of blocks, which lie side by side."""
    task, rows = None, []
    for batch in batches:
        numbers = [batch.column(k).to_pylist() for k in (0, 1, 2, 3, 4, 5, 7)]
        sets = batch.column(6)
        for i, (component, low, high, right, key, doc, copies) in enumerate(zip(*numbers)):
            if task != (component, low, high):
                if rows:
                    yield rows
                task, rows = (component, low, high), []
            rows.append({
                "right": right, "key": key, "doc": doc, "copies": copies, "own": sets[i].values.to_numpy(),
                "inner": low == high,
            })
    if rows:
        yield rows


def _links(rows: list[dict], percent: int, pairs: bool, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    inner = rows[0]["inner"]
    left = [r for r in rows if not r["right"]]
    right = left if inner else [r for r in rows if r["right"]]
    linked = {r["key"]: 0 for r in rows}
    for i in range(0, len(left), ROWS):
        for j in range(i if inner else 0, len(right), ROWS):
            own, other = left[i : i + ROWS], right[j : j + ROWS]
            common = _common(own, other)
            n = np.array([len(r["own"]) for r in own])[:, None]
            m = np.array([len(r["own"]) for r in other])[None, :]
            similar = 100 * common >= percent * (n + m - common)
            if inner and i == j:
                similar &= np.arange(len(own))[:, None] < np.arange(len(other))[None, :]
            x, y = np.nonzero(similar)
            if pairs:
                ends = [sorted((own[a]["doc"], other[b]["doc"])) for a, b in zip(x, y)]
                columns = [[e[0] for e in ends], [e[1] for e in ends], common[x, y].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
                )
                continue
            given = similar @ np.array([r["copies"] for r in other])
            taken = similar.T @ np.array([r["copies"] for r in own])
            for r, k in zip(own, given.tolist()):
                linked[r["key"]] += k
            for r, k in zip(other, taken.tolist()):
                linked[r["key"]] += k
    if not pairs:
        found = {k: v for k, v in linked.items() if v}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], schema=schema
        )


def _common(own: list[dict], other: list[dict]) -> np.ndarray:
    """How many elements the sets of either list share, by products of strips of 0 and 1."""
    flat = [np.concatenate([r["own"] for r in side]) for side in (own, other)]
    places = [np.repeat(np.arange(len(side)), [len(r["own"]) for r in side]) for side in (own, other)]
    both = np.intersect1d(*flat)  # other elements are in no overlap
    kept = []
    for values, place in zip(flat, places):
        at = np.minimum(np.searchsorted(both, values), max(len(both) - 1, 0))
        there = both[at] == values if len(both) else np.zeros(len(values), bool)
        order = np.argsort(at[there], kind="stable")
        kept.append((at[there][order], place[there][order]))
    out = np.zeros((len(own), len(other)), dtype=np.int64)
    for begin in range(0, len(both), COLUMNS):
        strips = []
        for (at, place), side in zip(kept, (own, other)):
            low, high = np.searchsorted(at, (begin, begin + COLUMNS))
            strip = np.zeros((len(side), min(COLUMNS, len(both) - begin)), dtype=np.float32)
            strip[place[low:high], at[low:high] - begin] = 1
            strips.append(strip)
        out += (strips[0] @ strips[1].T).astype(np.int64)
    return out
