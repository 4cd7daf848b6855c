"""Flat rows to documents, pages to flat rows, ids to request chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.operators.joins import match
from reelstat.operators.ordinals import running_total

# Fixed value: ids per request.
CHUNK_SIZE = 50

# Children are dealt out in the order of a 64-bit hash, cut into so many runs at most.
CHILD_RUNS = 1 << 20

# From so many children a document, the keys that need several are few enough to list: one in as many
# children at most.
LISTED_ITEMS = 1_000

# Pages of a key that one task puts in order; they carry their ids along.
PAGE_BLOCK = 1 << 14


def assemble_documents(
    parents: DataFrame,
    children: DataFrame,
    key: str,
    array: str = "videos",
    max_items: int = 10_000,
    fields: list[Column] | None = None,
) -> DataFrame:
    """Documents of a parent with its children as an array of structs, sorted by their fields.

    Every document has ``part``, counted from 0, and ``parts``, the number of its parent's documents:
    as many as ``max_items`` children each need, and one with an empty array for a parent without
    children. So no task has to hold a whole hot key, and the rows look the same at any size. All
    parts but the last hold ``max_items`` children; which children follows from a hash of them, so it
    is the same after a retry.

    Only keys with more than ``max_items`` children are dealt out by that hash; of those, exact copies
    are counted before the shuffle. The children of all others go to their document in one shuffle,
    ahead of the aggregation, which would else sort whole scan tasks by key and spill them. That
    shuffle keeps all partitions the session names: merged by their size as shuffled, they would be too
    large for memory as rows.

    A child's fields are the columns of ``children`` but the key, or ``fields`` if given: expressions
    on those columns and the key. That shuffle moves the columns, and the fields are made after it, so
    that numbers are moved rather than their texts, and constants not at all.
    """
    children = children.filter(F.col(key).isNotNull())
    if fields is None:
        fields = [F.col(name) for name in children.columns if name != key]
    if max_items < LISTED_ITEMS:
        return _in_parts(parents, children.select(key, *fields), key, array, max_items)
    counts = children.groupBy(key).agg(F.count("*").alias("_n"))
    hot = F.broadcast(counts.filter(F.col("_n") > max_items).select(key))
    partitions = int(children.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arrays = (
        children.join(hot, key, "left_anti")
        .repartition(partitions, key)
        .select(key, F.struct(*fields).alias("_item"))
        .groupBy(key)
        .agg(F.sort_array(F.collect_list("_item")).alias(array))
    )
    joined = parents.join(hot, key, "left_anti").join(arrays, key, "left")
    empty = F.array().cast(joined.schema[array].dataType)
    whole = joined.select(
        *parents.columns,
        F.lit(0).cast("bigint").alias("part"),
        F.lit(1).cast("bigint").alias("parts"),
        F.coalesce(array, empty).alias(array),
    )
    of_hot = children.join(hot, key, "left_semi").select(key, *fields)
    cut = _in_parts(parents.join(hot, key, "left_semi"), of_hot, key, array, max_items)
    return whole.unionAll(cut)


def _in_parts(
    parents: DataFrame, children: DataFrame, key: str, array: str, max_items: int
) -> DataFrame:
    """Documents of keys any of which may be too large for a task."""
    fields = [name for name in children.columns if name != key]
    per_child = children.groupBy(key, *fields).agg(F.count("*").alias("_n"))
    hashed = per_child.withColumn("_hash", F.xxhash64(*fields))
    placed = running_total(
        hashed, [key], "_hash", "_n", "_before", block=(1 << 64) // CHILD_RUNS, levels=1
    )
    first, last = F.col("_before"), F.col("_before") + F.col("_n") - 1
    size = F.lit(max_items).cast("bigint")
    pieces = placed.select(
        key, F.struct(*fields).alias("_item"), first.alias("_first"), last.alias("_last"),
        F.explode(F.sequence(F.floor(first / size), F.floor(last / size))).alias("part"),
    )
    start, end = F.col("part") * size, (F.col("part") + 1) * size - 1
    copies = F.least("_last", end) - F.greatest("_first", start) + 1
    arrays = (
        pieces.withColumn("_copies", copies.cast("int"))
        .groupBy(key, "part")
        .agg(
            F.sort_array(
                F.flatten(F.collect_list(F.array_repeat("_item", F.col("_copies"))))
            ).alias(array)
        )
    )
    # One slot per document to come, so that the join below runs on (key, part): that is how the
    # arrays are already partitioned, and it keeps the parts of a hot key apart.
    sizes = per_child.groupBy(key).agg(F.sum("_n").alias("_n"))
    slots = match(parents, sizes, [key], "left").withColumn(
        "parts", F.greatest(F.ceil(F.coalesce("_n", F.lit(0)) / size), F.lit(1)).cast("bigint")
    )
    slots = slots.withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    )
    joined = slots.join(arrays, [key, "part"], "left")
    empty = F.array().cast(joined.schema[array].dataType)
    return joined.select(
        *parents.columns, "part", "parts", F.coalesce(array, empty).alias(array)
    )


def flatten_pages(
    pages: DataFrame,
    key: str,
    page: str,
    ids: str,
    out: str = "videoId",
    block: int = PAGE_BLOCK,
) -> DataFrame:
    """The ids of all pages of a key, one row each, with their position in the whole list.

    ``page`` is an integer that orders the pages of a key; pages may differ in length. The list
    stays flat, so its length is not bounded by what one row can hold.
    """
    sized = pages.select(key, page, ids, F.coalesce(F.size(ids), F.lit(0)).alias("_size"))
    sized = sized.withColumn("_size", F.greatest("_size", F.lit(0)).cast("bigint"))
    placed = running_total(sized, [key], page, "_size", "_start", block)
    return placed.select(key, "_start", F.posexplode(ids).alias("_offset", out)).select(
        key, (F.col("_start") + F.col("_offset")).alias("position"), out
    )


def chunk_ids(
    listed: DataFrame, key: str, ids: str, position: str = "position", size: int = CHUNK_SIZE
) -> DataFrame:
    """Ids joined by commas in groups of ``size``, following their zero-based position.

    A group holds ``size`` ids at most, whatever the size of the key.
    """
    member = F.struct(position, F.col(ids).cast("string").alias("_id"))
    members = F.sort_array(F.collect_list(member))
    return (
        listed.groupBy(key, F.expr(f"`{position}` div {int(size)}").alias("chunk"))
        .agg(members.alias("_members"))
        .select(key, "chunk", F.array_join(F.col("_members._id"), ",").alias("ids"))
    )
