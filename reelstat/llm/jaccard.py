"""Jaccard join of documents on word n-grams, by prefix filtering with the rarest n-grams first.

Two texts whose sets overlap enough share an n-gram within the first few of each set, in any order
that all documents agree on. That is used twice:

1. A fixed share of all n-grams, chosen by hash, comes first in the order and is counted over the
   whole corpus. A text that has more such n-grams of its own alone than a prefix holds has no
   partner; most texts end here.
2. The whole sets of the others are counted among themselves, and the rarest n-grams of each make its
   prefix. Candidates meet in the buckets of these n-grams, pass length, positional and suffix
   filters, and are verified once a pair on their whole sets.

Equal sets form one class from the start. Components are found in two steps, neither of which makes
all pairs of a group: first every member of a bucket is compared with the bucket's most connected set;
then, in buckets that still hold several components, members outside the largest one are compared
with members of other components. A pair that is never compared lies within one component already.

All links lie within the components, so the join itself is done there: the sets of a component are
dealt into blocks of bounded size, and each pair of blocks meets in one task, which counts the common
n-grams of all its pairs by matrix products. A task gives the links of its sets, as sums or as pairs.

Defined results: null and empty texts, and texts without words, have an empty set and are linked
with nothing; a text with fewer than n words is one n-gram; rows with a null id have a null component
and link nothing; rows with the same id and text are one document, and rows with the same id but
different texts share a component; an empty table gives an empty one; only the id and the text are
read, so further columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelstat.llm.common import forget, map_arrow, mix, signed, text_bytes, windows_of, words_of
from reelstat.llm.blocks import linked_in_blocks
from reelstat.llm.components import components
from reelstat.operators.joins import match
from reelstat.session import written

#: How many times the longest prefix is counted first. Texts of which more than this share is found
#: elsewhere by chance go on to the second part, so a larger number keeps that part small.
COUNTED = 1.8

#: Cells into which the suffix filter divides the sets.
CELLS = 16


def shingles_of(data: bytes, n: int) -> np.ndarray:
    """The distinct n-grams of a text as sorted 64-bit hashes, case folded in ASCII."""
    words = words_of(data.lower())[2]
    if 0 < len(words) < n:
        return windows_of(words, len(words)) ^ np.uint64(len(words))
    return np.unique(windows_of(words, n))


def set_key(shingles: np.ndarray) -> int:
    """A hash of a set."""
    total = np.add.reduce(mix(shingles)) + np.uint64(len(shingles))
    return int(signed(mix(np.array([total], dtype=np.uint64)))[0])


def prefix_length(size: int, percent: int) -> int:
    """A set with a partner shares one of so many first elements with it."""
    return size - (percent * size + 99) // 100 + 1


def _prefix(size: Column, percent: int) -> Column:
    return (size - F.floor((percent * size + 99) / 100) + 1).cast("long")


def sketches(docs: DataFrame, id_column: str, text_column: str, n: int, percent: int) -> DataFrame:
    """For each row its id, the size and key of its set, and the n-grams that are counted first."""
    limit = np.uint64(int((100 - percent) * COUNTED / 100 * 2**64))

    def rows(batch: pa.RecordBatch) -> dict:
        sizes, keys, first = [], [], []
        for value in batch.column(1):
            found = shingles_of(value.as_py(), n)
            sizes.append(len(found))
            keys.append(set_key(found) if len(found) else None)
            first.append(signed(found[found * np.uint64(0xD6E8FEB86659FD93) < limit]))
        return {
            "doc_id": batch.column(0), "n": pa.array(sizes, pa.int64()),
            "key": pa.array(keys, pa.int64()), "first": pa.array(first, pa.list_(pa.int64())),
        }

    kind = docs.schema[id_column].dataType.simpleString()
    slim = docs.select(F.col(id_column).alias("doc_id"), text_bytes(text_column).alias("data"))
    return map_arrow(slim, rows, f"doc_id {kind}, n long, key long, first array<long>")


def suspects(classes: DataFrame, percent: int) -> DataFrame:
    """(key, rep) of the classes (key, doc_id, n, first) that may have a partner."""
    grams = classes.select("key", F.explode("first").alias("shingle"))
    # An n-gram of one set only tells that set by itself, so no join is needed.
    alone = (
        grams.groupBy("shingle").agg(F.count("*").alias("sets"), F.min("key").alias("key"))
        .filter("sets = 1").groupBy("key").agg(F.count("*").alias("alone"))
    )
    sizes = classes.select("key", F.col("doc_id").alias("rep"), "n")
    return sizes.join(alone, "key", "left").filter(
        F.coalesce("alone", F.lit(0)) < _prefix(F.col("n"), percent)
    ).select("key", "rep")


def whole_sets(
    docs: DataFrame, wanted: DataFrame, id_column: str, text_column: str, n: int
) -> DataFrame:
    """(key, doc_id, n, own, cells): the sets of the classes ``wanted`` (key, rep), in full, and the
    sizes of their parts by hash."""
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("rep"), text_bytes(text_column).alias("data"))

    def rows(batch: pa.RecordBatch) -> dict:
        keep, sets, cells = [], [], []
        for i, (key, value) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2))):
            found = shingles_of(value.as_py(), n)
            if len(found) and set_key(found) == key:
                keep.append(i)
                sets.append(signed(found))
                cells.append(np.bincount((found >> np.uint64(60)).view(np.int64), minlength=CELLS))
        at = pa.array(keep, pa.int64())
        return {
            "key": batch.column(0).take(at), "doc_id": batch.column(1).take(at),
            "n": pa.array([len(x) for x in sets], pa.int64()),
            "own": pa.array(sets, pa.list_(pa.int64())), "cells": pa.array(cells, pa.list_(pa.int64())),
        }

    joined = texts.join(wanted, "rep").select("key", "rep", "data")
    return map_arrow(
        joined, rows, f"key long, doc_id {kind}, n long, own array<long>, cells array<long>"
    ).dropDuplicates(["key"])


def needed(left: Column, right: Column, percent: int) -> Column:
    """The smallest overlap of two sets of these sizes that reaches the similarity."""
    return F.ceil(percent * (left + right) / F.lit(100 + percent))


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(shingle, key, n, place, shared): the prefix of each set (key, n, own) without n-grams of one
    set only, and how many of the set's n-grams other sets have."""
    grams = sets.select("key", F.explode("own").alias("shingle"))
    shared = grams.groupBy("shingle").agg(F.count("*").alias("sets")).filter("sets > 1")
    # Another name for the n-gram makes the next step deal by set, whatever the join dealt by.
    found = grams.join(shared, "shingle").select(
        "key", "sets", F.bitwise_not("shingle").alias("gram")
    ).join(sets.select("key", "n"), "key")
    own = Window.partitionBy("key")
    found = found.withColumns({
        "rank": F.row_number().over(own.orderBy("sets", "gram")) - 1,
        "shared": F.count("*").over(own),
    })
    # N-grams that no other set has come first and are left out.
    place = (F.col("rank") + F.col("n") - F.col("shared")).cast("long")
    return found.withColumn("place", place).filter(
        F.col("place") < _prefix(F.col("n"), percent)
    ).select(F.bitwise_not("gram").alias("shingle"), "key", "n", "place", "shared")


def _possible(percent: int) -> Column:
    """Length filter on a pair. N-grams that no other set has can't be part of an overlap either."""
    low, high = F.least("n", "m"), F.greatest("n", "m")
    bound = F.least("shared", "other_shared")
    return (100 * low >= percent * high) & (bound >= needed(F.col("n"), F.col("m"), percent))


def _pairs(joined: DataFrame, before: Column, percent: int) -> DataFrame:
    """Pairs by a positional filter at the n-grams where they meet: besides the ``before`` n-grams
    that they may share earlier, they share no more than follows in either set."""
    rest = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("other_place"))
    return (
        joined.filter((F.col("key") != F.col("other")) & _possible(percent))
        .filter(before + rest >= needed(F.col("n"), F.col("m"), percent))
        .select(F.least("key", "other").alias("x"), F.greatest("key", "other").alias("y"))
        .distinct()
    )


def _suffix_filtered(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets, cut into cells by hash, can overlap enough."""
    side = lambda a: classes.select(
        F.col("key").alias(a), F.col("n").alias(f"n{a}"), F.col("cells").alias(f"c{a}")
    )
    bound = F.aggregate(
        F.zip_with("cx", "cy", lambda a, b: F.least(a, b)), F.lit(0).cast("long"), lambda a, b: a + b
    )
    joined = pairs.join(side("x"), "x").join(side("y"), "y")
    return joined.filter(bound >= needed(F.col("nx"), F.col("ny"), percent)).select("x", "y")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) that are similar enough, by their whole sets."""
    side = lambda a: sets.select(F.col("key").alias(a), F.col("own").alias(f"s{a}"))
    joined = pairs.join(side("x"), "x").join(side("y"), "y")
    same = F.size(F.array_intersect("sx", "sy"))
    total = F.size("sx") + F.size("sy") - F.col("same")
    checked = joined.withColumn("same", same).filter(100 * F.col("same") >= percent * total)
    return checked.select("x", "y").distinct()


def _named(links: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the representatives' ids."""
    side = lambda a, b: classes.select(F.col("key").alias(a), F.col("doc_id").alias(b))
    return links.join(side("x", "a"), "x").join(side("y", "b"), "y").select("a", "b")


def jaccard_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", n: int = 4,
    percent: int = 85, links: bool = False,
) -> DataFrame:
    """One row for each row of ``docs``: (id, n_shingles, component_id), where the component is the
    smallest id that links of at least ``percent`` / 100 similarity reach. With ``links`` also
    n_links: how many other documents have a link with it."""
    return _joined(docs, id_column, text_column, n, percent, "counts" if links else None)


def jaccard_links(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", n: int = 4,
    percent: int = 85,
) -> DataFrame:
    """All links between different sets, once each: (a, b, common), with the smallest ids that have
    these sets and the n-grams they share. Documents with equal sets are told by ``jaccard_classes``."""
    return _joined(docs, id_column, text_column, n, percent, "pairs")


def jaccard_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", n: int = 4,
    percent: int = 85,
) -> DataFrame:
    """(id, class_id) of the rows with a set: the smallest id that has the same one."""
    found = sketches(docs, id_column, text_column, n, percent).filter("key IS NOT NULL")
    smallest = found.groupBy("key").agg(F.min("doc_id").alias("class_id"))
    return match(found.select("doc_id", "key"), smallest, ["key"]).select(
        F.col("doc_id").alias(id_column), "class_id"
    )


def _joined(
    docs: DataFrame, id_column: str, text_column: str, n: int, percent: int, links: str | None
) -> DataFrame:
    spark = docs.sparkSession
    wanted_links = links
    found = written(sketches(docs, id_column, text_column, n, percent), "jaccard-sketches")
    rows = written(found.select("doc_id", "n", "key"), "jaccard-rows")
    named = found.filter("doc_id IS NOT NULL AND key IS NOT NULL")
    classes = written(
        named.groupBy("key").agg(
            F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("first").alias("first")
        ),
        "jaccard-classes",
    )
    forget(spark, found)
    names = written(classes.select("key", F.col("doc_id").alias("rep")), "jaccard-names")
    wanted = written(suspects(classes, percent), "jaccard-suspects")
    forget(spark, classes)
    sets = written(whole_sets(docs, wanted, id_column, text_column, n), "jaccard-sets")
    slim = sets.select("key", "doc_id", "n", "cells")
    prefix = written(prefixes(sets, percent), "jaccard-prefixes")
    forget(spark)

    # Each set against the one of its bucket that shares the most.
    hubs = prefix.groupBy("shingle").agg(
        F.max(F.struct("shared", "n", "key", "place")).alias("hub"), F.count("*").alias("members")
    ).filter("members > 1").select(
        "shingle", F.col("hub.n").alias("m"), F.col("hub.key").alias("other"),
        F.col("hub.place").alias("other_place"), F.col("hub.shared").alias("other_shared"),
    )
    first = written(
        _suffix_filtered(_pairs(prefix.join(hubs, "shingle"), F.least("place", "other_place"), percent), slim, percent),
        "jaccard-pairs",
    )
    links = written(_named(_verified(first, sets, percent), slim), "jaccard-links")
    groups = written(components(links), "jaccard-components")

    # What is still apart although it shares a bucket.
    place = slim.select("key", "doc_id").join(groups, F.col("doc_id") == F.col("node"), "left").select(
        "key", F.coalesce("component", "doc_id").alias("component")
    )
    members = written(prefix.join(place, "key"), "jaccard-members")
    counts = members.groupBy("shingle", "component").agg(F.count("*").alias("size"))
    largest = counts.groupBy("shingle").agg(
        F.max(F.struct("size", "component")).alias("most"), F.count("*").alias("parts")
    ).filter("parts > 1").select("shingle", F.col("most.component").alias("most"))
    open_members = members.join(largest, "shingle")
    outside = open_members.filter(F.col("component") != F.col("most")).select(
        "shingle", F.col("key").alias("other"), F.col("n").alias("m"),
        F.col("place").alias("other_place"), F.col("shared").alias("other_shared"),
        F.col("component").alias("other_component"), "most",
    )
    # Two members outside the largest component meet twice; one of the rows is enough.
    once = (F.col("component") == F.col("most")) | (F.col("key") < F.col("other"))
    apart = members.join(outside, "shingle").filter(
        (F.col("component") != F.col("other_component")) & once
    )
    # Here a pair meets at all n-grams of both prefixes, so also at the first that they share.
    second = _pairs(apart, F.lit(0), percent).join(first, ["x", "y"], "left_anti")
    second = written(_suffix_filtered(second, slim, percent), "jaccard-pairs")
    if not second.isEmpty():
        more = written(_named(_verified(second, sets, percent), slim), "jaccard-links")
        groups = written(components(links.unionAll(more)), "jaccard-components")

    copies = rows.filter("doc_id IS NOT NULL AND key IS NOT NULL").distinct().groupBy("key").agg(
        F.count("*").alias("copies")
    )
    if wanted_links:
        together = sets.join(groups, F.col("doc_id") == F.col("node")).join(copies, "key").select(
            "component", "key", "doc_id", "n", "own", "copies"
        )
        together = written(together, "jaccard-together")
        found_links = linked_in_blocks(together, percent, pairs=wanted_links == "pairs")
        if wanted_links == "pairs":
            return found_links
        found_links = written(found_links, "jaccard-counts")
    forget(spark, sets, prefix, members, first, second)
    component = names.join(
        groups, F.col("rep") == F.col("node"), "left"
    ).select("key", F.coalesce("component", "rep").alias("component_id"))
    out = rows.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key"))
    out = out.join(component, "key", "left")
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    columns = [F.col("doc_id").alias(id_column), F.col("n").alias("n_shingles"), own.alias("component_id")]
    if wanted_links:
        # Other documents with the same set, and all with a linked one.
        counts = copies.join(found_links, "key", "left").select(
            "key", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
        )
        out = out.join(counts, "key", "left")
        columns.append(F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return out.select(*columns)


def drop_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", n: int = 5,
    percent: int = 80,
) -> DataFrame:
    """The documents without those that a smaller id stands for; rows without an id stay."""
    groups = jaccard_components(docs, id_column, text_column, n, percent)
    gone = groups.filter(F.col("component_id") < F.col(id_column)).select(
        F.col(id_column).alias("__id")
    ).distinct()
    return docs.join(gone, F.col(id_column) == F.col("__id"), "left_anti")
