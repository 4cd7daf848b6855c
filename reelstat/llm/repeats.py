"""Exact repeats of byte strings by a distributed enhanced suffix array.

A suffix array of a corpus is built bucket by bucket. The smallest hash among the short grams of a
string (its anchor) depends on the string alone, so suffixes that share ``length`` bytes lie in one
bucket, and only anchors that occur more than once are followed up. Within a bucket the suffixes are
sorted, neighbours' common prefixes are taken, and a scan with a stack gives the tree of common-prefix
intervals. An interval of at least ``length`` bytes whose suffixes have different bytes to their left
is a maximal repeat; all its occurrences form a group. A repeat that is longer than a bucket's stretch
of text gives one group for each stretch.

Stretches of text that are equal are counted first (tasks add up their own), and only the first of
them takes part. A bucket that still holds more stretches than ``Limits.bucket`` is not sorted in one
task: its strings of ``length`` bytes are grouped by hash instead, which finds the same bytes.

Anchors, strings and texts are told apart by 64-bit hashes.

Defined results: a null or short text has no repeat; a null id counts as the smallest; rows equal in
id and text are one document; texts that differ under one id are taken in the order of their hashes;
an empty table gives an empty one; matches never cross documents, and columns other than the id and
the text are not read. Ids are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import (
    forget, gram_hashes, map_arrow, signed, span_hashes, text_bytes,
)
from reelstat.session import written

#: Bytes of the grams that anchors are chosen from.
GRAM = 20
_NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Limits:
    #: Distinct stretches of a bucket that one task sorts.
    bucket: int = 50_000
    #: Bytes of stretches that are sorted together.
    chunk: int = 4 << 20


def text_hash(data: bytes) -> int:
    found = span_hashes(data, np.array([0]), np.array([len(data)]))
    return int(signed(found)[0])


def stretches(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of string starts that have the same anchor in the same place: anchors, first starts,
    numbers of starts. Of equal grams the first one counts, but for places 4096 bytes apart, where it
    is the second; that parts a run, and its strings meet in the same bucket all the same."""
    smallest, width = gram_hashes(data, GRAM), length - GRAM + 1
    place = np.arange(len(smallest), dtype=np.uint64) & np.uint64(4095)
    smallest = (smallest >> np.uint64(12) << np.uint64(12)) | place
    if len(smallest) < width:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    size = 1
    while 2 * size <= width:
        smallest, size = np.minimum(smallest[:-size], smallest[size:]), 2 * size
    rest = width - size
    if rest:
        smallest = np.minimum(smallest[:-rest], smallest[rest:])
    first = np.flatnonzero(np.concatenate(([True], smallest[1:] != smallest[:-1])))
    return smallest[first] >> np.uint64(12), first, np.diff(np.append(first, len(smallest)))


def anchors(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, stretch, doc, text, start, n) for texts (doc, data): ``stretch`` is the hash of the
    bytes that the ``n`` strings from ``start`` cover, ``text`` that of the whole text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for begin in range(0, len(docs), 256):
                found = []
                for doc, value in zip(docs[begin : begin + 256], batch.column(1)[begin : begin + 256]):
                    data = value.as_py()
                    keys, first, n = stretches(data, length)
                    if len(keys):
                        ends = first + n + length - 1
                        hashes = span_hashes(data, np.append(first, 0), np.append(ends, len(data)))
                        found.append((
                            signed(keys), signed(hashes[:-1]), np.full(len(keys), doc),
                            np.full(len(keys), signed(hashes[-1:])[0]), first, n,
                        ))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in zip(*found)],
                        ["anchor", "stretch", "doc", "text", "start", "n"],
                    )

    return texts.select("doc", "data").mapInArrow(
        rows, "anchor long, stretch long, doc long, text long, start long, n long"
    )


def intervals(prefixes: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """The tree of common-prefix intervals, children first: (depth, first, last) of all intervals of
    at least ``least`` bytes. ``prefixes[i]`` is what suffix i shares with suffix i - 1."""
    stack: list[tuple[int, int]] = []
    for i, shared in enumerate([*prefixes, 0]):
        first = i - 1
        while stack and stack[-1][0] > shared:
            depth, first = stack.pop()
            yield depth, first, i - 1
        if shared >= least and (not stack or stack[-1][0] < shared):
            stack.append((shared, first))


class Bucket:
    """The suffixes of some stretches that have a repeat of ``length`` bytes, in order.

    ``rows`` are (doc, text, start, left, data): ``left`` tells that the data begins a byte before
    the stretch.
    """

    def __init__(self, rows: list[tuple], length: int):
        self.length = length
        hashes, owner, offset = [], [], []
        for k, (_, _, _, left, data) in enumerate(rows):
            found = gram_hashes(data, length)[left:]
            hashes.append(found)
            owner.append(np.full(len(found), k))
            offset.append(np.arange(len(found)))
        hashes = np.concatenate(hashes)
        owner, offset = np.concatenate(owner), np.concatenate(offset)
        _, at, times = np.unique(hashes, return_inverse=True, return_counts=True)
        own = np.flatnonzero(times[at] > 1)  # no other suffix is in an interval this deep
        self._set(sorted(
            suffix_at(rows[k], i, length) for k, i in zip(owner[own].tolist(), offset[own].tolist())
        ))

    @classmethod
    def of_suffixes(cls, suffixes: list[tuple], length: int) -> Bucket:
        """The same from suffixes in order, as ``suffix_at`` gives them."""
        bucket = cls.__new__(cls)
        bucket.length = length
        bucket._set(suffixes)
        return bucket

    def _set(self, suffixes: list[tuple]) -> None:
        self.suffixes = suffixes
        self.before = [x[4] for x in suffixes]
        self.prefixes = _common_prefixes([x[0] for x in suffixes])

    def groups(self) -> Iterator[tuple[int, list[tuple]]]:
        """Maximal repeats: their length and all occurrences (doc, text, start)."""
        for depth, first, last in intervals(self.prefixes, self.length):
            before = self.before[first : last + 1]
            if before[0] < 0 or before.count(before[0]) < len(before):
                yield depth, [x[1:4] for x in self.suffixes[first : last + 1]]

    def covers(self) -> Iterator[tuple[int, int, int, int]]:
        """(doc, text, start, end) of what also starts earlier, each suffix in its deepest maximal
        repeat with an earlier occurrence."""
        where = [(x[1], x[3], x[2]) for x in self.suffixes]
        # Intervals not yet inside another: first, last, suffixes without a cover, the earliest one,
        # and the byte to their left if it is one for all.
        done: list[tuple[int, int, list[int], int, int]] = []
        for depth, first, last in intervals(self.prefixes, self.length):
            inner = []
            while done and done[-1][0] >= first:
                inner.append(done.pop())
            parts, at = [], first
            for part in reversed(inner):
                parts += [(i, i, [i], i, self.before[i]) for i in range(at, part[0])]
                parts.append(part)
                at = part[1] + 1
            parts += [(i, i, [i], i, self.before[i]) for i in range(at, last + 1)]
            earliest = min((x[3] for x in parts), key=where.__getitem__)
            left = {x[4] for x in parts}
            byte = left.pop() if len(left) == 1 else -1
            waiting = max((x[2] for x in parts), key=len)
            for part in parts:
                if part[2] is not waiting:
                    waiting += part[2]
            if byte < 0:
                stay = []
                for i in waiting:
                    if where[i] > where[earliest]:
                        doc, start, text = where[i]
                        yield doc, text, start, start + depth
                    else:
                        stay.append(i)
                waiting = stay
            done.append((first, last, waiting, earliest, byte))


def suffix_at(row: tuple, i: int, length: int) -> tuple[bytes, int, int, int, int]:
    """(bytes, doc, text, start, byte before or -1) of the suffix at place ``i`` of a stretch. Every so
    many bytes a new group begins, so what is compared may end, too."""
    doc, text, start, left, data = row
    before = -1 if i % (length + 28) == 0 or i + left == 0 else data[i + left - 1]
    return data[i + left : i + left + 2 * length + 56], doc, text, start + i, before


def _common_prefixes(suffixes: list[bytes]) -> list[int]:
    """How many bytes each suffix shares with the one before it."""
    if not suffixes:
        return []
    out = [0]
    for k in range(0, len(suffixes) - 1, 4096):
        part = suffixes[k : k + 4097]
        width = max(map(len, part))
        codes = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in part), dtype=np.uint8)
        codes = codes.reshape(len(part), width)
        sizes = np.array([len(x) for x in part])
        differs = codes[1:] != codes[:-1]
        shared = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
        out += np.minimum(shared, np.minimum(sizes[1:], sizes[:-1])).tolist()
    return out


class Repeats:
    """What the search has found: ``texts`` (doc, data), and tables of the steps."""

    def __init__(
        self, docs: DataFrame, id_column: str, text_column: str, length: int, limits: Limits
    ):
        self.length, self.limits = length, limits
        doc = F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID))
        self.texts = docs.select(doc.alias("doc"), text_bytes(text_column).alias("data"))
        found = written(anchors(self.texts, length), "repeat-anchors")
        often = found.groupBy("anchor").agg(F.count("*").alias("times")).filter("times > 1")
        self.shared = written(found.join(often.select("anchor"), "anchor"), "repeat-shared")
        forget(self.texts.sparkSession, found)
        # The first of equal stretches takes part for all of them.
        self.kinds = written(
            self.shared.groupBy("anchor", "stretch").agg(
                F.min(F.struct("doc", "start", "text", "n")).alias("first"), F.count("*").alias("times")
            ),
            "repeat-kinds",
        )
        sizes = self.kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
        self.parts = self.kinds.join(sizes, "anchor").select(
            "anchor", "first.*", (F.col("kinds") > limits.bucket).alias("large")
        )

    def copies(self) -> DataFrame:
        """(doc, text, start, end) of stretches that are equal to an earlier one."""
        firsts = self.kinds.filter("times > 1").select("anchor", "stretch", "first")
        mine = F.struct("doc", "start", "text")
        first = F.struct("first.doc", "first.start", "first.text")
        return self.shared.join(firsts, ["anchor", "stretch"]).filter(mine != first).select(
            "doc", "text", "start", (F.col("start") + F.col("n") + self.length - 1).alias("end")
        )

    def _stretches(self) -> DataFrame:
        """(anchor, large, doc, text, start, left, data) of the stretches that take part."""
        length = self.length
        # As many rows as a document has anchors.
        wanted = self.parts.groupBy("doc", "text").agg(
            F.collect_list(F.struct("anchor", "large", "start", "n")).alias("parts")
        )

        def rows(batch: pa.RecordBatch) -> list[dict]:
            out = []
            for i in range(batch.num_rows):
                doc, text, data = (batch.column(k)[i].as_py() for k in (0, 1, 2))
                if text_hash(data) == text:
                    for part in batch.column(3)[i].as_py():
                        start, left = part["start"], int(part["start"] > 0)
                        end = start + part["n"] + length - 1
                        out.append((
                            part["anchor"], part["large"], doc, text, start, left, data[start - left : end],
                        ))
            names = ["anchor", "large", "doc", "text", "start", "left", "data"]
            return [
                dict(zip(names, map(pa.array, zip(*out[k : k + 10_000]))))
                for k in range(0, len(out), 10_000)
            ]

        joined = self.texts.join(wanted, "doc").select("doc", "text", "data", "parts")
        return map_arrow(
            joined, rows,
            "anchor long, large boolean, doc long, text long, start long, left long, data binary",
        )

    def _buckets(self, parts: DataFrame, what, schema: str) -> DataFrame:
        """``what`` of each bucket; buckets are sorted some at a time."""
        length, chunk = self.length, self.limits.chunk

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            waiting: list[tuple] = []
            size, anchor = 0, None

            def done():
                found = list(what(Bucket([x[1:] for x in waiting], length))) if waiting else []
                names = [x.split()[0] for x in schema.split(", ")]
                for k in range(0, len(found), 50_000):
                    columns = zip(*found[k : k + 50_000])
                    yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in columns], names)

            for batch in batches:
                for row in zip(*(batch.column(k).to_pylist() for k in range(6))):
                    if row[0] != anchor and size > chunk:
                        yield from done()
                        waiting, size = [], 0
                    anchor = row[0]
                    size += len(row[5])
                    waiting.append(row)
            yield from done()

        own = parts.filter("NOT large").select("anchor", "doc", "text", "start", "left", "data")
        return own.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(rows, schema)

    def _split(self, parts: DataFrame, what, schema: str) -> DataFrame:
        """``what`` of the parts of the large buckets, whose suffixes Spark sorts."""
        length = self.length

        def suffixes(batch: pa.RecordBatch) -> Iterator[dict]:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                strings = gram_hashes(row[4], length)[row[3] :]
                found = [suffix_at(row, i, length) for i in range(len(strings))]
                if found:
                    columns = dict(zip(("suffix", "doc", "text", "place", "before"), zip(*found)))
                    yield {"string": signed(strings)} | {k: pa.array(v) for k, v in columns.items()}

        every = map_arrow(
            parts.filter("large").select("doc", "text", "start", "left", "data"), suffixes,
            "string long, suffix binary, doc long, text long, place long, before long",
        )
        often = every.groupBy("string").agg(F.count("*").alias("times")).filter("times > 1")
        order = ["string", "suffix", "doc", "text", "place"]
        placed = every.join(often.select("string"), "string").repartition("string").sortWithinPartitions(*order)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = [x.split()[0] for x in schema.split(", ")]
            waiting, string = [], None

            def done():
                found = list(what(Bucket.of_suffixes(waiting, length))) if waiting else []
                for k in range(0, len(found), 50_000):
                    columns = zip(*found[k : k + 50_000])
                    yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in columns], names)

            for batch in batches:
                for row in zip(*(batch.column(k).to_pylist() for k in range(6))):
                    if row[0] != string:
                        yield from done()
                        waiting, string = [], row[0]
                    waiting.append(row[1:])
            yield from done()

        return placed.select("string", "suffix", "doc", "text", "place", "before").mapInArrow(rows, schema)

    def covers(self) -> DataFrame:
        """(doc, text, start, end): together they hold every byte of a string that also starts
        earlier."""
        length = self.length
        parts = written(self._stretches(), "repeat-stretches")
        schema = "doc long, text long, start long, end long"
        small = self._buckets(parts, Bucket.covers, schema)

        def strings(batch: pa.RecordBatch) -> list[dict]:
            out = []
            for i in range(batch.num_rows):
                doc, text, start, left, data = (batch.column(k)[i].as_py() for k in range(5))
                found = signed(gram_hashes(data, length)[left:])
                n = len(found)
                out.append({
                    "string": found, "doc": np.full(n, doc), "text": np.full(n, text),
                    "start": start + np.arange(n),
                })
            return out

        large = map_arrow(
            parts.filter("large").select("doc", "text", "start", "left", "data"), strings,
            "string long, doc long, text long, start long",
        )
        place = F.struct("doc", "start", "text")
        firsts = large.groupBy("string").agg(F.min(place).alias("first"), F.count("*").alias("times"))
        many = large.join(firsts.filter("times > 1"), "string").filter(place != F.col("first")).select(
            "doc", "text", "start", (F.col("start") + length).alias("end")
        )
        return self.copies().unionAll(small).unionAll(many)

    def groups(self) -> DataFrame:
        """(length, group, doc_id, start): the maximal repeats with all their occurrences.

        Stretches that several places have in full are a group as well. Buckets beyond
        ``Limits.bucket`` are split by the first ``length`` bytes of their suffixes: an interval of the
        tree has them in common, so it lies in one part.
        """
        length = self.length

        def listed(bucket: Bucket) -> Iterator[tuple]:
            for depth, places in bucket.groups():
                name = hash((depth, *min(places)))
                for doc, text, start in places:
                    yield depth, name, doc, text, start

        schema = "length long, group long, doc long, text long, place long"
        parts = written(self._stretches(), "repeat-stretches")
        found = self._buckets(parts, listed, schema).unionAll(self._split(parts, listed, schema))
        # Each occurrence stands for those in equal stretches.
        owners = self.kinds.select(
            "anchor", "stretch", F.col("first.doc").alias("doc"), F.col("first.text").alias("text"),
            F.col("first.start").alias("begin"), F.col("first.n").alias("n"),
        )
        inside = (F.col("place") >= F.col("begin")) & (F.col("place") < F.col("begin") + F.col("n"))
        owned = found.join(owners, ["doc", "text"]).filter(inside).select(
            "length", "group", "anchor", "stretch", (F.col("place") - F.col("begin")).alias("offset")
        )
        whole = self.kinds.filter("times > 1").select(
            (F.col("first.n") + length - 1).alias("length"), F.xxhash64("anchor", "stretch").alias("group"),
            "anchor", "stretch", F.lit(0).cast("long").alias("offset"),
        )
        return owned.unionAll(whole).join(self.shared, ["anchor", "stretch"]).select(
            "length", "group", F.col("doc").alias("doc_id"),
            (F.col("start") + F.col("offset")).alias("start"),
        )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that touch or overlap become one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for start, end in spans:
        kept.append(data[at:start])
        at = end
    return b"".join([*kept, data[at:]])


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 100,
    limits: Limits = Limits(), with_bytes: bool = False,
) -> DataFrame:
    """One row for each row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256, the removed
    spans in bytes and, if asked for, what is kept."""
    found = Repeats(docs, id_column, text_column, length, limits)
    covers = written(found.covers(), "repeat-covers")
    # As many as a document has anchors, and starts of strings at most.
    spans = covers.groupBy("doc", "text").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")
    ).groupBy("doc").agg(F.collect_list(F.struct("text", "spans")).alias("found"))
    forget(docs.sparkSession)
    joined = found.texts.join(spans, "doc", "left").select("doc", "data", "found")

    def rows(batch: pa.RecordBatch) -> dict:
        out = []
        for i in range(batch.num_rows):
            data, by_text = batch.column(1)[i].as_py(), batch.column(2)[i].as_py() or []
            key = text_hash(data) if by_text else 0
            own = [(x["start"], x["end"]) for y in by_text if y["text"] == key for x in y["spans"]]
            own = merged(own)
            kept = without(data, own)
            out.append((
                len(data), len(data) - len(kept), len(own), hashlib.sha256(kept).hexdigest(),
                [{"start": a, "end": b} for a, b in own], kept,
            ))
        kinds = {"kept_sha256": pa.string(), "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), "kept": pa.binary()}
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"] + ["kept"] * with_bytes
        doc = pa.array([None if x == _NO_ID else x for x in batch.column(0).to_pylist()], pa.int64())
        return {"doc": doc} | {
            name: pa.array([x[k] for x in out], kinds.get(name, pa.int64()))
            for k, name in enumerate(names)
        }

    schema = (
        "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<start: long, end: long>>" + ", kept binary" * with_bytes
    )
    return map_arrow(joined, rows, schema).withColumnRenamed("doc", id_column)
