"""Benchmark decontamination by spaced seeds.

Fixed masks choose some of the tokens under a window and ignore the others, so that a passage in
which words were replaced still shares seeds with the original. Seeds of the benchmark are joined
with those of the documents, and around every hit the two texts are compared token by token.

The benchmark is a query set that is worked off in blocks of bounded size; each block is sent to the
executors and meets every document, so documents are never shuffled.

Defined results: null or empty texts and items without a token match nothing; items shorter than a
mask use the part of the mask that they cover; several rows with the same id each give their own
matches, and equal matches are given once; a table without rows gives none; only the id and the text
column are read, so further columns do not matter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import BASE, map_arrow, mix, text_bytes, words_of

#: 1: the token counts, 0: it may differ. Between them they pass a replaced word at any regular
#: distance of three tokens or more, and most irregular ones.
MASKS = ("111101111", "1110111011", "11011011011", "110010101101")

#: Further masks for items of fewer than ``SHORT`` tokens, in which a replaced word leaves little.
SHORT_MASKS = ("1111", "11011", "1101011")
SHORT = 20

#: Bytes of benchmark text that one block holds about.
BLOCK_BYTES = 16 << 20

PUNCTUATION = bytes(
    x + 32 if 65 <= x <= 90 else 32 if x < 128 and not chr(x).isalnum() else x for x in range(256)
)
_FILTER_BITS = 22

#: Hits of a mask in a text that are listed one by one, and cells of texts that are compared at once.
HITS, CELLS = 1 << 18, 1 << 20


@dataclass(frozen=True)
class Overlap:
    """What counts as a leak: a stretch of aligned tokens, scored +1 for an equal token and
    ``-penalty`` for a different one, with so many equal tokens (an item's length, if smaller).

    With ``share``, that share of the item's tokens is enough where it is less than ``min_equal``, but
    no fewer than ``min_evidence`` tokens; an item of fewer tokens leaks only as a whole and into a
    document of which it makes half at least."""

    min_equal: int = 12
    penalty: float = 2.0
    share: float | None = None
    min_evidence: int = 6

    def needed(self, item: int, document: int) -> int:
        """Equal tokens that an item and a document of so many tokens need."""
        if self.share is None:
            return min(self.min_equal, item)
        if item < self.min_evidence:
            return item if 2 * item >= document else item + 1
        return min(self.min_equal, max(math.ceil(self.share * item), self.min_evidence))


#: The rule of the operators: with this penalty a passage with every third word replaced counts whole.
LEAK = Overlap(penalty=1.0, share=0.6)


def tokens_of(data: bytes) -> np.ndarray:
    """Hashes of a text's tokens: lower case in ASCII, punctuation taken as space."""
    return words_of(data.translate(PUNCTUATION))[2]


def seeds_of(tokens: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """The seed at each position that the mask fits."""
    last = len(tokens) - len(mask) + 1
    if last < 1:
        return np.zeros(0, dtype=np.uint64)
    found = np.full(last, np.uint64(salt + 1))
    for k, used in enumerate(mask):
        if used == "1":
            found = found * BASE + tokens[k : last + k]
    return mix(found)


class Index:
    """Seeds and tokens of one block of the benchmark."""

    def __init__(self, rows: list[tuple[int, bytes]], masks: tuple[str, ...] = MASKS):
        self.ids = [i for i, _ in rows]
        self.tokens = [tokens_of(x) for _, x in rows]
        self.masks: list[str] = []
        hashes, items, places = [], [], []
        for n, tokens in enumerate(self.tokens):
            own = masks + SHORT_MASKS if len(tokens) < SHORT else masks
            fitted = {m[: len(tokens)].rstrip("0") for m in own} - {""}
            for mask in fitted:
                if mask not in self.masks:
                    self.masks.append(mask)
                found = seeds_of(tokens, mask, self.masks.index(mask))
                hashes.append(found)
                items.append(np.full(len(found), n))
                places.append(np.arange(len(found)))
        empty = [np.zeros(0, dtype=np.uint64)]
        seeds = np.concatenate(hashes or empty)
        order = np.argsort(seeds, kind="stable")
        self.seeds = seeds[order]
        self.items = np.concatenate(items or empty).astype(np.int64)[order]
        self.places = np.concatenate(places or empty).astype(np.int64)[order]
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[(self.seeds >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def diagonals(self, tokens: np.ndarray) -> np.ndarray:
        """The distinct (item, offset) on which the text shares a seed with an item."""
        found: list[np.ndarray] = []
        marked: dict[int, np.ndarray] = {}
        for salt, mask in enumerate(self.masks):
            seeds = seeds_of(tokens, mask, salt)
            at = np.flatnonzero(self.filter[(seeds >> np.uint64(64 - _FILTER_BITS)).view(np.int64)])
            if not len(at):
                continue
            first = np.searchsorted(self.seeds, seeds[at], "left")
            n = np.searchsorted(self.seeds, seeds[at], "right") - first
            if n.sum() > HITS:
                # Repeated seeds on both sides: mark offsets instead of listing every hit.
                self._mark(tokens, seeds[at], at, marked)
                continue
            hits = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found.append(
                np.stack((self.items[hits], np.repeat(at, n) - self.places[hits]), axis=1)
            )
        for item, offsets in marked.items():
            hit = np.flatnonzero(offsets) - len(self.tokens[item])
            found.append(np.stack((np.full(len(hit), item), hit), axis=1))
        if not found:
            return np.zeros((0, 2), dtype=np.int64)
        return np.unique(np.concatenate(found), axis=0)

    def _mark(self, tokens: np.ndarray, seeds: np.ndarray, at: np.ndarray, marked: dict[int, np.ndarray]) -> None:
        """Marks the offsets at which the text shares one of the seeds with an item: one step for
        each different seed and its place in an item, however often the text has it."""
        order = np.argsort(seeds, kind="stable")
        values, begin = np.unique(seeds[order], return_index=True)
        for value, places in zip(values, np.split(at[order], begin[1:])):
            low, high = np.searchsorted(self.seeds, value, "left"), np.searchsorted(self.seeds, value, "right")
            for k in range(low, high):
                item = int(self.items[k])
                if item not in marked:
                    marked[item] = np.zeros(len(self.tokens[item]) + len(tokens), dtype=bool)
                marked[item][places - self.places[k] + len(self.tokens[item])] = True

    def matches(self, data: bytes, rule: Overlap) -> dict[int, tuple[int, int, int, int]]:
        """By item number the best verified stretch: equal tokens, length, start in the document
        and start in the item, in tokens. The first of equal ones wins."""
        tokens = tokens_of(data)
        found = self.diagonals(tokens)
        best: dict[int, tuple[int, int, int, int]] = {}
        items, begin = np.unique(found[:, 0], return_index=True)
        for n, offsets in zip(items.tolist(), np.split(found[:, 1], begin[1:]) if len(items) else ()):
            item = self.tokens[n]
            count, offset = _best_offset(item, tokens, offsets, rule.penalty)
            if count >= rule.needed(len(item), len(tokens)):
                low, high = max(0, -offset), min(len(item), len(tokens) - offset)
                equal = item[low:high] == tokens[low + offset : high + offset]
                start, end = best_stretch(equal, rule.penalty)
                best[n] = (count, end - start, low + offset + start, low + start)
        return best


def _best_offset(item: np.ndarray, tokens: np.ndarray, offsets: np.ndarray, penalty: float) -> tuple[int, int]:
    """Of the offsets, which rise, the first whose best stretch has the most equal tokens."""
    most, where = 0, 0
    step = max(CELLS // len(item), 1)
    inside = np.arange(len(item))
    for k in range(0, len(offsets), step):
        own = offsets[k : k + step]
        at = own[:, None] + inside[None, :]
        outside = (at < 0) | (at >= len(tokens))
        equal = (tokens[np.where(outside, 0, at)] == item[None, :]) & ~outside
        counts = _counts(equal, outside, penalty)
        first = int(counts.argmax())
        if counts[first] > most:
            most, where = int(counts[first]), int(own[first])
        if most == len(item):
            break
    return most, where


def _counts(equal: np.ndarray, outside: np.ndarray, penalty: float) -> np.ndarray:
    """For each row the equal tokens of its best stretch, none of which reaches outside."""
    score = np.where(equal, 1.0, np.where(outside, -float(equal.shape[1] * (1 + penalty) + 1), -penalty))
    zero = np.zeros((len(equal), 1))
    sums = np.concatenate((zero, np.cumsum(score, axis=1)), axis=1)
    lowest = np.minimum.accumulate(sums, axis=1)
    rises = sums - lowest
    end = rises.argmax(axis=1)
    rows = np.arange(len(equal))
    start_sum = lowest[rows, end]
    start = (sums == start_sum[:, None]).argmax(axis=1)
    # The last end with the same score and start, as in ``best_stretch``.
    same = (rises == rises[rows, end][:, None]) & (lowest == start_sum[:, None])
    last = same.shape[1] - 1 - same[:, ::-1].argmax(axis=1)
    seen = np.concatenate((np.zeros((len(equal), 1), np.int64), np.cumsum(equal, axis=1)), axis=1)
    return seen[rows, last] - seen[rows, start]


def best_stretch(equal: np.ndarray, penalty: float) -> tuple[int, int]:
    """Start and end of the stretch with the highest score, the first of equal ones, as long as it
    can be with that score."""
    sums = np.concatenate(([0.0], np.cumsum(np.where(equal, 1.0, -penalty))))
    lowest = np.minimum.accumulate(sums)
    scores = sums - lowest
    end = int(np.argmax(scores))
    start = int(np.argmin(sums[: end + 1]))
    return start, int(np.flatnonzero((scores == scores[end]) & (lowest == sums[start]))[-1])


MATCHES = "n_equal long, n_compared long, doc_start long, item_start long"


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text", rule: Overlap = LEAK,
    masks: tuple[str, ...] = MASKS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row for each document and item that overlap: ids, counts and starts in tokens."""
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(item_column).alias("item"), text_bytes(item_text).alias("data")
    ).distinct()
    total = items.agg(F.sum(F.length("data"))).first()[0] or 0
    blocks = 1 + total // block_bytes
    slim = docs.select(F.col(id_column).alias("id"), text_bytes(text_column).alias("data"))
    kinds = [docs.schema[id_column].dataType, benchmark.schema[item_column].dataType]
    schema = f"id {kinds[0].simpleString()}, item {kinds[1].simpleString()}, {MATCHES}"

    found = None
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("data"), F.lit(blocks)) == block)
        rows = [(r["item"], bytes(r["data"])) for r in own.collect()]
        index = spark.sparkContext.broadcast(Index(sorted(rows, key=repr), masks))
        part = map_arrow(slim, _searcher(index, rule), schema)
        found = part if found is None else found.unionAll(part)
    return found.dropDuplicates().toDF(id_column, item_column, *found.columns[2:])


def _searcher(index, rule: Overlap):
    def rows(batch: pa.RecordBatch) -> dict:
        hits = [
            (i, n, *figures)
            for i in range(batch.num_rows)
            for n, figures in index.value.matches(batch.column(1)[i].as_py(), rule).items()
        ]
        columns = {
            "id": batch.column(0).take(pa.array([x[0] for x in hits], pa.int64())),
            "item": pa.array([index.value.ids[x[1]] for x in hits]),
        }
        for k, name in enumerate(MATCHES.replace(" long", "").split(", ")):
            columns[name] = pa.array([x[2 + k] for x in hits], pa.int64())
        return columns if hits else []

    return rows


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The documents that overlap with no item, with all their columns. Rows with a null id are kept
    unless their own text overlaps."""
    hits = contaminated(docs, benchmark, id_column, **options)
    ids = hits.select(F.col(id_column).alias("__id")).distinct()
    return docs.join(ids, docs[id_column].eqNullSafe(ids["__id"]), "left_anti")
