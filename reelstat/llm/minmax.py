"""Near duplicates by min-max hashing.

A permutation of the n-grams is a hash; a document's signature keeps both the smallest and the largest
value that its set has under each of them. Either agrees between two sets with the probability of
their Jaccard similarity, so a signature of 2 k values costs k hashes of each n-gram, and an estimate
from it varies less than one from k hashes' minima alone.

1. Equal sets form one class. Each class gets its signature, cut into bands of a few values; classes
   that agree in a whole band share a bucket. With the defaults a pair of similarity 0.85 shares none
   with a probability of 3 in 10 million, one of 0.8 with one of 6 in 100,000.
2. Every member of a bucket is verified against the bucket's smallest document, on whole sets.
3. In buckets whose members are still in several components, the members outside the largest one are
   verified against the members of other components. A pair of a bucket that is never compared lies
   in one component already, so buckets of any size give all components without all their pairs.

Before a pair is verified its sizes must allow the similarity, and so must bounds of its overlap: two
sets share no more than either has in common with any other set of a bucket, in all and in each of
CELLS parts of the n-grams' hashes. These bounds lose no link. They are part of the join on buckets,
so pairs of a large group that can't be linked are never written or shuffled.

Defined results: null and empty texts, and texts without words, have an empty set and are linked with
nothing; a text with fewer than n words is one n-gram; rows with a null id link nothing, have a null
component and are kept; rows with the same id share a component, whatever their texts; an empty table
gives an empty one; only the id and the text are read, so further columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import BASE, map_arrow, mix, signed, text_bytes
from reelstat.llm.components import components
from reelstat.llm.jaccard import needed, set_key, shingles_of
from reelstat.session import removed, written

#: Parts of the n-grams in which common ones are counted.
CELLS = 32

#: n-grams that are hashed together; their hashes stay in a core's cache.
TOGETHER = 1 << 16


@dataclass(frozen=True)
class Bands:
    """Permutations, each of which gives two values, and values of a band."""

    permutations: int = 96
    values: int = 6
    seed: int = 11

    @property
    def count(self) -> int:
        return 2 * self.permutations // self.values

    def multipliers(self) -> np.ndarray:
        numbers = np.arange(1, self.permutations + 1, dtype=np.uint64) + np.uint64(self.seed << 32)
        return mix(numbers * BASE) | np.uint64(1)


def signatures(sets: list[np.ndarray], bands: Bands) -> np.ndarray:
    """For each of the sets, none of them empty, the minima and then the maxima of its hashes."""
    k = bands.permutations
    out = np.empty((len(sets), 2 * k), dtype=np.uint64)
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sets):
        done = ends[begin] - sizes[begin]
        stop = max(begin + 1, int(np.searchsorted(ends, done + TOGETHER, side="right")))
        flat = np.concatenate(sets[begin:stop])
        starts = ends[begin:stop] - sizes[begin:stop] - done
        for i, factor in enumerate(bands.multipliers()):
            hashes = flat * factor
            hashes ^= hashes >> np.uint64(29)
            out[begin:stop, i] = np.minimum.reduceat(hashes, starts)
            out[begin:stop, k + i] = np.maximum.reduceat(hashes, starts)
        begin = stop
    return out


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The estimate of the Jaccard similarity that two signatures give."""
    return float((a == b).mean())


def buckets_of(signature: np.ndarray, bands: Bands) -> np.ndarray:
    """For each signature one number for each band."""
    cells = signature[:, : bands.count * bands.values].reshape(len(signature), bands.count, bands.values)
    out = np.tile(mix(np.arange(1, bands.count + 1, dtype=np.uint64) * BASE), (len(signature), 1))
    for j in range(bands.values):
        out = mix(out * BASE + cells[:, :, j])
    return out


def sketches(
    docs: DataFrame, id_column: str, text_column: str, n: int, bands: Bands
) -> DataFrame:
    """For each row its id, the size and key of its set, and its buckets."""

    def rows(batch: pa.RecordBatch) -> dict:
        sets = [shingles_of(value.as_py(), n) for value in batch.column(1)]
        full = [x for x in sets if len(x)]
        found = iter(signed(buckets_of(signatures(full, bands), bands)) if full else ())
        return {
            "doc_id": batch.column(0), "n": pa.array([len(x) for x in sets], pa.int64()),
            "key": pa.array([set_key(x) if len(x) else None for x in sets], pa.int64()),
            "buckets": pa.array([next(found) if len(x) else None for x in sets], pa.list_(pa.int64())),
        }

    kind = docs.schema[id_column].dataType.simpleString()
    slim = docs.select(F.col(id_column).alias("doc_id"), text_bytes(text_column).alias("data"))
    return map_arrow(slim, rows, f"doc_id {kind}, n long, key long, buckets array<long>")


def whole_sets(
    docs: DataFrame, wanted: DataFrame, id_column: str, text_column: str, n: int
) -> DataFrame:
    """(key, own): the sets of the classes ``wanted`` (key, rep), in full, by their texts."""
    texts = docs.select(F.col(id_column).alias("rep"), text_bytes(text_column).alias("data"))

    def rows(batch: pa.RecordBatch) -> dict:
        keys, sets = [], []
        for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = shingles_of(value.as_py(), n)
            if len(found) and set_key(found) == key:  # the id may have other texts too
                keys.append(key)
                sets.append(signed(found))
        return {"key": pa.array(keys, pa.int64()), "own": pa.array(sets, pa.list_(pa.int64()))}

    joined = texts.join(wanted, "rep").select("key", "data")
    return map_arrow(joined, rows, "key long, own array<long>").dropDuplicates(["key"])


def profiles(sets: DataFrame) -> DataFrame:
    """(key, n, shared, cells): how many n-grams each set has, how many of them another set has too,
    and how many of these by their first bits."""
    grams = sets.select("key", F.explode("own").alias("gram"))
    # An n-gram of one set tells that set by itself, so no join is needed.
    alone = grams.groupBy("gram").agg(F.count("*").alias("sets"), F.min("key").alias("key")).filter(
        "sets = 1"
    ).groupBy("key").agg(F.collect_list("gram").alias("alone"))

    def rows(batch: pa.RecordBatch) -> dict:
        sizes, cells = [], []
        for own, alone in zip(batch.column(1), batch.column(2)):
            sizes.append(len(own))
            cells.append(_parts(own.values) - (_parts(alone.values) if alone.is_valid else 0))
        return {
            "key": batch.column(0), "n": pa.array(sizes, pa.int64()),
            "shared": pa.array([int(x.sum()) for x in cells], pa.int64()),
            "cells": pa.array(cells, pa.list_(pa.int64())),
        }

    return map_arrow(
        sets.join(alone, "key", "left").select("key", "own", "alone"), rows,
        "key long, n long, shared long, cells array<long>",
    )


def _parts(grams: pa.Array) -> np.ndarray:
    bits = np.uint64(64 - CELLS.bit_length() + 1)
    return np.bincount(
        (grams.to_numpy().view(np.uint64) >> bits).view(np.int64), minlength=CELLS
    )


def _possible(percent: int) -> Column:
    """Whether the sets (n, shared, cells) and (m, also, parts) can be similar enough."""
    least = needed(F.col("n"), F.col("m"), percent)
    common = F.aggregate(
        F.zip_with("cells", "parts", lambda a, b: F.least(a, b)), F.lit(0).cast("long"), lambda a, b: a + b
    )
    return (
        (100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
        & (F.least("shared", "also") >= least) & (common >= least)
    )


def _other(table: DataFrame) -> DataFrame:
    return table.withColumnsRenamed({"n": "m", "shared": "also", "cells": "parts"})


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs of keys (x, y) that are similar enough. Only the sets of x travel with the pairs."""
    side = lambda a: sets.select(F.col("key").alias(a), F.col("own").alias(f"s{a}"))
    joined = pairs.join(side("x"), "x").join(side("y"), "y")
    joined = joined.withColumn("same", F.size(F.array_intersect("sx", "sy")))
    total = F.size("sx") + F.size("sy") - F.col("same")
    return joined.filter(100 * F.col("same") >= percent * total).select("x", "y")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", n: int = 5,
    percent: int = 80, bands: Bands = Bands(),
) -> DataFrame:
    """One row for each row of ``docs``: (id, n_shingles, component_id, kept), where the component is
    the smallest id that links of at least ``percent`` / 100 similarity reach; kept rows have it."""
    found = written(sketches(docs, id_column, text_column, n, bands), "minmax-sketches")
    rows = written(found.select("doc_id", "n", "key"), "minmax-rows")
    classes = written(
        found.filter("doc_id IS NOT NULL AND key IS NOT NULL").groupBy("key").agg(
            F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
            F.first("buckets").alias("buckets"),
        ),
        "minmax-classes",
    )
    removed(found)
    names = classes.select("key", F.col("doc_id").alias("rep"))
    entries = classes.select("key", "doc_id", "n", F.explode("buckets").alias("bucket"))
    hubs = entries.groupBy("bucket").agg(
        F.min(F.struct("doc_id", "key", "n")).alias("hub"), F.count("*").alias("members")
    ).filter("members > 1").select(
        "bucket", F.col("hub.key").alias("hub"), F.col("hub.n").alias("hub_n")
    )
    members = written(entries.join(hubs, "bucket"), "minmax-members")
    sets = written(
        whole_sets(docs, members.select("key", F.col("doc_id").alias("rep")).distinct(),
                   id_column, text_column, n),
        "minmax-sets",
    )
    profile = written(profiles(sets), "minmax-profiles")

    # Each member against the smallest document of its bucket.
    alike = 100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
    to_hub = members.filter((F.col("key") != F.col("hub")) & alike).select(
        F.col("key").alias("x"), F.col("hub").alias("y")
    ).distinct()
    to_hub = to_hub.join(profile.withColumnRenamed("key", "x"), "x").join(
        _other(profile).withColumnRenamed("key", "y"), "y"
    )
    first = written(to_hub.filter(_possible(percent)).select("x", "y"), "minmax-pairs")
    links = written(_named(verified(first, sets, percent), names).unionAll(_same_id(rows, names)), "minmax-links")
    groups = written(components(links), "minmax-components")

    # Pairs that share a bucket but no component yet.
    component = F.coalesce("component", "doc_id").alias("component")
    placed = written(
        members.join(groups, F.col("doc_id") == F.col("node"), "left").select("bucket", "key", component),
        "minmax-placed",
    )
    largest = placed.groupBy("bucket", "component").agg(F.count("*").alias("size")).groupBy("bucket").agg(
        F.max(F.struct("size", "component")).alias("most"), F.count("*").alias("parts")
    ).filter("parts > 1").select("bucket", F.col("most.component").alias("most"))
    inside = written(placed.join(largest, "bucket").join(profile, "key"), "minmax-open")
    outside = _other(inside.filter(F.col("component") != F.col("most"))).select(
        "bucket", F.col("key").alias("other"), F.col("component").alias("apart"), "m", "also", "parts",
    )
    # Two members outside the largest component meet twice; one of the rows is enough.
    once = (F.col("component") == F.col("most")) | (F.col("key") < F.col("other"))
    second = inside.join(outside, "bucket").filter(
        (F.col("component") != F.col("apart")) & once & _possible(percent)
    ).select(F.least("key", "other").alias("x"), F.greatest("key", "other").alias("y")).distinct()
    tried = first.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    second = written(second.join(tried, ["x", "y"], "left_anti"), "minmax-pairs")
    if not second.isEmpty():
        more = written(_named(verified(second, sets, percent), names), "minmax-links")
        groups = written(components(links.unionAll(more)), "minmax-components")
    for table in (members, sets, profile, first, placed, inside, second):
        removed(table)

    component = names.join(groups, F.col("rep") == F.col("node"), "left").select(
        "key", F.coalesce("component", "rep").alias("component_id")
    )
    out = rows.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key"))
    out = out.join(component, "key", "left")
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("doc_id").alias(id_column), F.col("n").alias("n_shingles"), own.alias("component_id"),
        F.col("doc_id").eqNullSafe(own).alias("kept"),
    )


def _named(links: DataFrame, names: DataFrame) -> DataFrame:
    """Links between the smallest ids of the classes."""
    side = lambda a, b: names.select(F.col("key").alias(a), F.col("rep").alias(b))
    return links.join(side("x", "a"), "x").join(side("y", "b"), "y").select("a", "b")


def _same_id(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Links from ids that have several texts to the classes of these."""
    several = rows.filter("doc_id IS NOT NULL AND key IS NOT NULL").groupBy("doc_id").agg(
        F.min("key").alias("low"), F.max("key").alias("high")
    ).filter("low < high").select("doc_id")
    return rows.join(several, "doc_id").join(names, "key").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b")
    )


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The documents that no smaller id stands for; rows without an id stay."""
    gone = near_duplicates(docs, id_column, **options).filter("NOT kept").select(
        F.col(id_column).alias("__id")
    ).distinct()
    return docs.join(gone, F.col(id_column) == F.col("__id"), "left_anti")
