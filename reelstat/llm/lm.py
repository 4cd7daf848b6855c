"""Language-model scores: a hidden Markov model trained by Baum-Welch on the corpus.

A word is emitted in two steps: a latent state emits a symbol, which is a frequent word, the end of
the text, or a class of words that end alike; a class then emits its word by how often the corpus has
it. The number of symbols follows the cube root of the training tokens, and that of the classes follows
it, so the model grows with the corpus, while the counts of all words stay a distributed table. Words are
told apart by 64-bit hashes.

1. Words of the training texts are counted; each task adds up its own first.
2. The frequent ones (a bounded number) are sent to the executors, and every text becomes a sequence
   of symbols. The other words of each text are joined with the table of counts.
3. Expected counts of starts, transitions and emissions are added up over all training texts, fold by
   fold: once a fold is counted its new counts replace its old ones, and the model is estimated again
   from all folds. No text is counted on the driver; training begins with seeded random emissions
   around the corpus's own, and ends when a pass over all folds gains little.
4. The scaled forward recursion gives the exact probability of every whole text's symbols.

Defined results: a null text is an empty one, which is a single end; a null id is held out or not by
the crc32 of the empty text; equal rows get equal scores; an empty table gives an empty one; without
training texts all words are unknown; only id and text are read, so further columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm import hmm
from reelstat.llm.common import fold, map_arrow, mix, signed, text_bytes, words_of, written_by
from reelstat.session import written


@dataclass(frozen=True)
class Shape:
    """Sizes of the model."""

    states: int = 6
    #: Words with a symbol of their own, for each cube root of the training tokens.
    words_per_root: float = 50.0
    #: Words with a symbol for each class of the others, which is told by their last two bytes.
    words_per_class: int = 32
    #: Words whose counts are sent to the executors, at most, unless more have symbols.
    head: int = 1 << 18
    #: Parts of the training texts after each of which the model is estimated anew, passes over them
    #: at most, and the gain of a pass below which training ends, as a share of the log likelihood.
    folds: int = 24
    passes: int = 2
    tolerance: float = 1e-4
    seed: int = 7

    def words(self, tokens: int) -> int:
        return math.ceil(self.words_per_root * math.cbrt(tokens))


def hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's words, case folded in ASCII, and their last two bytes."""
    data = data.lower()
    _, ends, hashes = words_of(data)
    codes = np.frombuffer(b" " + data, dtype=np.uint8).astype(np.int32)
    last = codes[ends] * 256 + codes[ends - 1] if len(ends) else ends.astype(np.int32)
    return hashes, last


def class_of(last: np.ndarray, classes: int) -> np.ndarray:
    return (mix(last.astype(np.uint64)) % np.uint64(classes)).astype(np.int64)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, last, n) of the words in a binary column ``data``; ``last`` are their last two bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [hashed(x.as_py()) for x in batch.column(0)]
            hashes = np.concatenate([x[0] for x in found] or [np.zeros(0, np.uint64)])
            last = np.concatenate([x[1] for x in found] or [np.zeros(0, np.int32)])
            words, first, n = np.unique(hashes, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(words)), pa.array(last[first].astype(np.int32)), pa.array(n)],
                ["word", "last", "n"],
            )

    counted = docs.select("data").mapInArrow(rows, "word long, last int, n long")
    return counted.groupBy("word").agg(F.min("last").alias("last"), F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, last bytes and counts of the words above the lowest count that at most ``limit`` words
    reach, by falling count. Counts are graded in steps of a sixteenth of a power of two."""
    grade = F.floor(F.log2("n") * 16)
    sizes = sorted(
        ((r["grade"], r["words"]) for r in
         counts.groupBy(grade.alias("grade")).agg(F.count("*").alias("words")).collect()),
        reverse=True,
    )  # a thousand rows at most
    lowest, total = None, 0
    for value, words in sizes:
        if total + words > limit:
            break
        lowest, total = value, total + words
    if lowest is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    head = counts.filter(grade >= lowest).select("word", "last", "n").toArrow()
    words, last, n = (head.column(k).to_numpy() for k in range(3))
    order = np.lexsort((words, -n))
    return words[order].view(np.uint64), last[order].astype(np.int64), n[order]


class Lexicon:
    """The frequent words and what scoring needs of the others."""

    def __init__(self, head, last_sums: list[tuple[int, int, int]], texts: int, shape: Shape):
        words, last, n = head
        self.tokens = sum(x[1] for x in last_sums) + texts
        self.distinct = sum(x[2] for x in last_sums) + (texts > 0)
        self.end_count = texts
        self.own = min(shape.words(self.tokens), len(words))
        self.classes = max(self.own // shape.words_per_class, 1)
        self.end = self.own + self.classes
        self.kind = np.uint16 if self.end < 1 << 16 else np.uint32
        #: Sums over classes are over all words, those with symbols are taken out again.
        total, distinct = np.zeros(self.classes), np.zeros(self.classes)
        if last_sums:
            ends, sums, rows = (np.array(x) for x in zip(*last_sums))
            of = class_of(ends, self.classes)
            np.add.at(total, of, sums)
            np.add.at(distinct, of, rows)
        classes = class_of(last, self.classes)
        top = slice(0, self.own)
        np.subtract.at(total, classes[top], n[top])
        np.subtract.at(distinct, classes[top], 1)
        self.class_log = np.log10(total + 0.5 * (distinct + 1))
        #: How often the training texts have each symbol.
        self.counts = np.concatenate((n[top], total, [texts])).astype(np.float64)
        symbols = self.own + classes
        symbols[top] = np.arange(self.own)
        order = np.argsort(words)
        self.words, self.symbols = words[order], symbols[order].astype(self.kind)
        self.logs = np.log10(n[order] + 0.5)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words among the frequent ones, and whether they are there."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return at, self.words[at] == hashes

    def encode(self, data: bytes) -> dict:
        """A text's symbols, the parts of its logs that are known here, and its other words."""
        hashes, last = hashed(data)
        symbols = np.empty(len(hashes) + 1, dtype=self.kind)
        symbols[-1] = self.end
        at, there = self.find(hashes)
        symbols[:-1][there] = self.symbols[at[there]]
        symbols[:-1][~there] = self.own + class_of(last[~there], self.classes)
        logs = self.logs[at[there]]
        in_class = symbols[:-1] >= self.own
        of_class = symbols[:-1][in_class].astype(np.int64) - self.own
        other, times = np.unique(hashes[~there], return_counts=True)
        return {
            "n_tokens": len(hashes) + 1,
            "n_known": int(there.sum()) + (self.end_count > 0),
            "base_log": float(logs.sum()) + float(np.log10(self.end_count + 0.5)),
            "class_log": float(logs[in_class[there]].sum()) - float(self.class_log[of_class].sum()),
            "symbols": symbols.tobytes(), "other": signed(other), "times": times.astype(np.int32),
        }


ENCODED = (
    "n_tokens long, n_known long, base_log double, class_log double, symbols binary, "
    "other array<long>, times array<int>"
)


def encode(docs: DataFrame, lexicon, id_kind: str) -> DataFrame:
    """(doc_id, held_out) of rows with their text in ``data``, and what ``Lexicon.encode`` gives."""

    def rows(batch: pa.RecordBatch) -> dict:
        found = [lexicon.value.encode(x.as_py()) for x in batch.column(2)]
        kinds = {
            "base_log": pa.float64(), "class_log": pa.float64(), "symbols": pa.binary(),
            "other": pa.list_(pa.int64()), "times": pa.list_(pa.int32()),
        }
        names = [x.split()[0] for x in ENCODED.split(", ")]
        return {"doc_id": batch.column(0), "held_out": batch.column(1)} | {
            k: pa.array([x[k] for x in found], kinds.get(k, pa.int64())) for k in names
        }

    return map_arrow(
        docs.select("doc_id", "held_out", "data"), rows,
        f"doc_id {id_kind}, held_out boolean, {ENCODED}",
    )


def sequences_of(column: pa.Array, kind: type = np.uint16) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), dtype=kind).astype(np.int64) for x in column]


def train_round(texts: DataFrame, model: hmm.Model, kind: type = np.uint16) -> hmm.Counts:
    """Expected counts over all texts: each task adds up its own, then they are added by cell."""
    states, symbols = len(model.start), len(model.emit)
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = hmm.Counts.none(states, symbols)
        for batch in batches:
            if batch.num_rows:
                total += hmm.expected_counts(shared.value, sequences_of(batch.column(0), kind))
        flat = total.flat()
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(flat[used])], ["cell", "n"])

    sums = texts.select("symbols").mapInArrow(rows, "cell long, n double")
    found = sums.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # a row for each parameter
    shared.destroy()
    flat = np.zeros(hmm.Counts.none(states, symbols).flat().size)
    flat[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return hmm.Counts.of_flat(flat, states, symbols)


def train(
    texts: DataFrame, counts: np.ndarray, shape: Shape, kind: type = np.uint16
) -> tuple[hmm.Model, list[float]]:
    """A model of the symbols of all ``texts`` (fold, symbols), and the log likelihood that each pass
    found. ``counts`` tells how often the texts have each symbol."""
    model = hmm.first_guess(counts, shape.states, shape.seed)
    by_fold: dict[int, hmm.Counts] = {}
    passes: list[float] = []
    while len(passes) < shape.passes and counts.any():
        for fold in range(shape.folds):
            by_fold[fold] = train_round(texts.filter(F.col("fold") == fold), model, kind)
            model = hmm.estimate(sum(by_fold.values(), hmm.Counts.none(*model.emit.shape[::-1])))
        passes.append(sum(x.log for x in by_fold.values()))
        if len(passes) > 1 and passes[-1] - passes[-2] < shape.tolerance * abs(passes[-2]):
            break
    return model, passes


def scores(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    held_out: Column | None = None, shape: Shape = Shape(),
) -> DataFrame:
    """One row for each document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out`` marks the documents that are scored but not learned from.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (held_out if held_out is not None else F.lit(False)).alias("held_out"),
        text_bytes(text_column).alias("data"),
    )
    learned = rows.filter(~F.col("held_out"))
    counts = written(count_words(learned), "lm-words")
    # A row for each pair of last bytes.
    sums = [tuple(r) for r in counts.groupBy("last").agg(F.sum("n"), F.count("*")).collect()]
    n_texts = learned.count()
    head = max(shape.head, shape.words(sum(x[1] for x in sums) + n_texts))
    lexicon = Lexicon(most_frequent(counts, head), sums, n_texts, shape)
    shared = spark.sparkContext.broadcast(lexicon)
    encoded = encode(rows, shared, kind).withColumn("row", F.monotonically_increasing_id())
    # Texts that are not learned from are a part of their own.
    fold = F.when(F.col("held_out"), -1).otherwise(F.pmod(F.xxhash64("symbols"), shape.folds))
    texts = written_by(encoded.withColumn("fold", fold.cast("int")), "lm-texts", "fold")
    model, _ = train(texts.filter("fold >= 0"), lexicon.counts, shape, lexicon.kind)
    model = spark.sparkContext.broadcast(model)

    other = texts.select("row", F.explode(F.arrays_zip("other", "times")).alias("x")).select(
        "row", F.col("x.other").alias("word"), F.col("x.times").alias("times")
    ).join(counts.select("word", "n"), "word", "left")
    other = other.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("other_log"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("other_known"),
    )
    base_norm = float(np.log10(max(lexicon.tokens + 0.5 * (lexicon.distinct + 1), 0.5)))
    joined = texts.select(
        "row", "doc_id", "held_out", "n_tokens", "n_known", "base_log", "class_log", "symbols"
    ).join(other, "row", "left").na.fill(0, ["other_log", "other_known"])
    scored = joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("other_known")).alias("n_known"),
        F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
        (F.col("base_log") + F.col("other_log") - F.col("n_tokens") * base_norm).alias("base_score"),
        (F.col("class_log") + F.col("other_log")).alias("word_log"), "symbols",
    )

    symbol_kind = lexicon.kind

    def forward(batch: pa.RecordBatch) -> dict:
        logs = hmm.log_likelihoods(model.value, sequences_of(batch.column(7), symbol_kind)) / np.log(10)
        columns = {name: batch.column(k) for k, name in enumerate(batch.schema.names[:6])}
        return columns | {"score": pa.array(logs + batch.column(6).to_numpy())}

    out = map_arrow(
        scored, forward,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
    return out.withColumnRenamed("doc_id", id_column)


def held_out_fold(id_column: str = "doc_id") -> Column:
    return fold(id_column, 5) == 1
