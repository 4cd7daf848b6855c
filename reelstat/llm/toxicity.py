"""Toxicity by two class-conditional Kneser-Ney models.

One bigram model learns from toxic documents, one from ordinary ones. Both back off to how many
contexts a word follows within the class, and that to how many it follows in both classes together;
expressions that are rare in both together weigh alike in both, and so do those whose split between
the classes chance explains: both models then use the counts of the two classes together, so ordinary
words add nothing to the comparison. A document's score is the difference of its length-normalised
log-likelihoods, turned into a probability by a logistic regression on that one number.

The models are fitted on a sample of labelled documents that is bounded (``Fit``), counts included;
scoring reads every document whole. Tokens are lower case in ASCII, punctuation is space.

Defined results: null and empty texts have no token and get the score of an even comparison; null
labels teach nothing, and a document labelled both ways counts as toxic; rows with a null id are
scored but never joined with a label; equal rows get equal scores; without labels of both classes
every score is 0; only id and text are read from the documents, so further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import BASE, fold, map_arrow, mix, signed, text_bytes, words_of
from reelstat.llm.decontaminate import PUNCTUATION
from reelstat.session import written


@dataclass(frozen=True)
class Fit:
    """Bounds of the sample that the models are fitted on."""

    #: Documents of each class, chosen by a hash of their id.
    documents: int = 4000
    #: Longer documents are not learned from.
    max_bytes: int = 200_000
    #: One in so many sampled documents fits the regression instead of the counts.
    calibration: int = 4


#: Bytes of a rare word that count as its stem.
STEM = 5
#: Likelihood ratio (G squared) from which a split between the classes is not taken for chance, about
#: one in a thousand by chance.
CHANCE = 10.8
#: Gaps below about this are all alike to the regression.
EVEN = 2e-2


def tokens_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's tokens and of their stems."""
    data = data.translate(PUNCTUATION)
    starts, ends, words = words_of(data)
    stems = words.copy()
    own = np.flatnonzero(ends - starts >= STEM)
    if len(own):
        codes = np.frombuffer(data, dtype=np.uint8)
        cut = np.stack([codes[starts[own] + k] for k in range(STEM)], axis=1).astype(np.uint64)
        stems[own] = mix(cut @ (BASE ** np.arange(STEM, dtype=np.uint64)))
    return words, stems


def contexts_of(tokens: np.ndarray) -> np.ndarray:
    """The token before each token, 0 at the start."""
    return np.concatenate((np.zeros(1, np.uint64), tokens[:-1])) if len(tokens) else tokens


class Models:
    """Both models as sorted tables: by pair and by word, the logs for [ordinary, toxic].

    Words and pairs that are rare in both classes together carry no evidence of their own: rare words
    share the place of their stem, or one place if that is rare too, and rare pairs leave their mass
    to the words' backoff counts.
    """

    def __init__(
        self, context: np.ndarray, word: np.ndarray, stem: np.ndarray, counts: np.ndarray,
        rare: float = 1e-5,
    ):
        """Distinct pairs (context, word), the word's stem and counts by class, shape (pairs, 2);
        expressions are rare below that share of all tokens, or three times."""
        weight = counts.sum(axis=1)
        rare = max(3, rare * weight.sum())
        self.words = _often(word, weight, rare)
        lost = ~_find(self.words, word)[1]
        self.stems = _often(stem[lost], weight[lost], rare)
        words, first = np.unique(word, return_index=True)
        right = self.places(word, stem)
        # A context is a word too; its stem is known from where it is one.
        at, there = _find(words, context)
        left = np.where(there, right[first][at], len(self.words) + len(self.stems))
        size = len(self.words) + len(self.stems) + 1
        left[context == 0] = size  # the start of a text
        cells, at = np.unique(left * size + right, return_inverse=True)
        seen = counts
        counts = _by_class(at, counts, len(cells))
        left, right = cells // size, cells % size

        both = counts.sum(axis=1, keepdims=True)
        share = counts.sum(axis=0) / both.sum()
        once, twice = (both == 1).sum(), (both == 2).sum()
        discount = once / (once + 2 * twice) if once else 0.5
        # Words that the classes use differently, and pairs that differ beyond what their words do.
        of_word = _by_class(right, counts, size)
        telling = beyond_chance(of_word)
        split = np.where(telling[:, None], of_word / np.maximum(of_word.sum(axis=1, keepdims=True), 1), share)
        telling_pairs = beyond_chance(counts)[:, None]
        counts = np.where(telling_pairs, counts, both * split[right])
        less = np.where(telling_pairs, discount, discount * counts / both)

        # In how many contexts a word follows, by class and in both together.
        pooled = np.bincount(right, minlength=size).astype(float)
        shared = np.maximum(pooled - discount, 0) / pooled.sum()
        shared += discount * (pooled > 0).sum() / pooled.sum() / size
        own = _by_class(right, _by_class(at, seen, len(cells)) > 0, size)
        follows = np.where(telling[:, None], own, pooled[:, None] * share)
        held = np.maximum(follows - np.where(telling[:, None], discount, discount * share), 0)
        held /= np.maximum(follows.sum(axis=0), 1e-9)
        lower = held + (1 - held.sum(axis=0)) * shared[:, None]

        total = _by_class(left, counts, size + 1)
        often = both[:, 0] >= rare
        kept = often[:, None] * np.maximum(counts - less, 0) / np.maximum(total[left], 1e-9)
        weight = np.maximum(1 - _by_class(left, kept, size + 1), 1e-9)
        logs = np.log(kept + weight[left] * lower[right])
        self.size, self.pairs = size, cells[often]
        self.pair_logs = logs[often].astype(np.float32)
        self.word_logs = np.log(lower).astype(np.float32)
        self.context_logs = np.log(weight).astype(np.float32)

    def places(self, words: np.ndarray, stems: np.ndarray) -> np.ndarray:
        """Frequent words have the first places in order, then frequent stems, then one is left."""
        at, there = _find(self.words, words)
        at_stem, there_stem = _find(self.stems, stems)
        return np.where(
            there, at, len(self.words) + np.where(there_stem, at_stem, len(self.stems))
        )

    def logs(self, words: np.ndarray, stems: np.ndarray) -> np.ndarray:
        """The log of each token's probability by both models, shape (tokens, 2); words that share a
        place share its probability."""
        right = self.places(words, stems)
        left = np.concatenate(([self.size], right[:-1]))
        backed_off = self.word_logs[right] + self.context_logs[left]
        if not len(self.pairs):
            return backed_off
        at, there = _find(self.pairs, left * self.size + right)
        return np.where(there[:, None], self.pair_logs[at], backed_off)

    def features(self, data: bytes) -> tuple[float, ...]:
        """Mean logs by the ordinary and the toxic model, and the log of how much larger the second is."""
        words, stems = tokens_of(data)
        if not len(words):
            return 0.0, 0.0, float(np.log(EVEN))
        ordinary, toxic = self.logs(words, stems).astype(np.float64).mean(axis=0)
        return ordinary, toxic, float(np.log(max(toxic - ordinary, 0.0) + EVEN))


def _by_class(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of both columns by place."""
    return np.stack([np.bincount(at, values[:, k], size) for k in (0, 1)], 1)


def beyond_chance(counts: np.ndarray, least: float = CHANCE) -> np.ndarray:
    """Rows whose split between two classes differs from that of all rows beyond chance."""
    share = counts.sum(axis=0) / max(counts.sum(), 1)
    expected = counts.sum(axis=1, keepdims=True) * share
    ratio = np.divide(counts, expected, out=np.ones(counts.shape), where=counts > 0)
    return 2 * (counts * np.log(ratio)).sum(axis=1) >= least


def _often(values: np.ndarray, weight: np.ndarray, least: int) -> np.ndarray:
    found, at = np.unique(values, return_inverse=True)
    return found[np.bincount(at, weight, len(found)) >= least]


def _find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, values), max(len(table) - 1, 0))
    return at, (table[at] == values) if len(table) else np.zeros(len(values), bool)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients of a weighted logistic regression, the intercept last, by Newton's method with
    steps halved until they gain."""
    scale = x.std(axis=0)
    scale = np.append(np.where(scale > 0, scale, 1.0), 1.0)
    x = np.column_stack((x, np.ones(len(x)))) / scale
    b = np.zeros(x.shape[1])

    def loss(b):
        z = x @ b
        return (weight * (np.logaddexp(0, z) - y * z)).sum() + ridge * (b[:-1] ** 2).sum() / 2

    keep = ridge * np.append(np.ones(len(b) - 1), 1e-6)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - keep * b
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(keep)
        step, now = np.linalg.solve(hessian, gradient), loss(b)
        while loss(b + step) > now and np.abs(step).max() > 1e-9:
            step /= 2
        b = b + step
        if np.abs(step).max() < 1e-7:
            break
    return b / scale


def fit(docs: DataFrame, labels: DataFrame, bounds: Fit = Fit()) -> tuple[Models, np.ndarray] | None:
    """Models and coefficients from documents (doc_id, data) and labels (doc_id, toxic)."""
    spark = docs.sparkSession
    labelled = docs.filter(F.length("data") <= bounds.max_bytes).join(
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")),
        "doc_id",
    )
    ids = written(labelled.select("doc_id", "toxic"), "toxic-labels")
    total = {r["toxic"]: r["n"] for r in ids.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not (total.get(0) and total.get(1)):
        return None
    order = F.xxhash64("doc_id")
    chosen = [
        ids.filter(F.col("toxic") == k).distinct().orderBy(order, "doc_id").limit(bounds.documents)
        for k in (0, 1)
    ]
    # Twice ``documents`` rows of an id and a label.
    sample = written(
        docs.join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id")
        .filter(F.length("data") <= bounds.max_bytes)
        .select("toxic", (F.pmod(order, F.lit(bounds.calibration)) == 0).alias("calibrate"), "data")
        .dropDuplicates(["toxic", "data"]),
        "toxic-sample",
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in (0, 1):
                own = [
                    tokens_of(x.as_py())
                    for label, x in zip(batch.column(0).to_pylist(), batch.column(1)) if label == k
                ]
                both = [np.stack((contexts_of(t), t, u), axis=1) for t, u in own if len(t)]
                if both:
                    pairs, n = np.unique(np.concatenate(both), axis=0, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(signed(np.ascontiguousarray(pairs[:, i]))) for i in range(3)),
                         pa.array(n * (k == 0)), pa.array(n * (k == 1))],
                        ["context", "word", "stem", "ordinary", "toxic"],
                    )

    counted = sample.filter("NOT calibrate").select("toxic", "data").mapInArrow(
        count, "context long, word long, stem long, ordinary long, toxic long"
    )
    table = counted.groupBy("context", "word", "stem").agg(
        F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")
    ).toArrow()  # bounded by the sample
    context, word, stem = (table.column(k).to_numpy().view(np.uint64) for k in range(3))
    counts = np.stack([table.column(k).to_numpy() for k in (3, 4)], axis=1)
    if not len(context):
        return None
    models = Models(context, word, stem, counts)
    shared = spark.sparkContext.broadcast(models)

    def measure(batch: pa.RecordBatch) -> dict:
        found = np.array([shared.value.features(x.as_py()) for x in batch.column(1)])
        return {"toxic": batch.column(0), "gap": pa.array(found[:, 2])}

    rows = map_arrow(
        sample.filter("calibrate").select("toxic", "data"), measure,
        "toxic int, gap double",
    ).toArrow()
    y, x = (rows.column(k).to_numpy().astype(float) for k in range(2))
    # Classes were sampled apart; weights give them back their frequencies.
    share = [total[k] / max((y == k).sum(), 1) for k in (0, 1)]
    weight = np.where(y == 1, share[1], share[0])
    return models, logistic(x[:, None], y, weight / weight.mean())


def scores(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", held_out: Column | None = None, threshold: float = 0.3,
    bounds: Fit = Fit(),
) -> DataFrame:
    """One row for each document: id, held_out, score, predicted and the two mean log-likelihoods."""
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (held_out if held_out is not None else F.lit(False)).alias("held_out"),
        text_bytes(text_column).alias("data"),
    )
    known = labels.select(
        F.col(id_column).alias("doc_id"), F.col(label_column).cast("int").alias("toxic")
    )
    fitted = fit(rows.filter(~F.col("held_out")).select("doc_id", "data"), known, bounds)
    shared = spark.sparkContext.broadcast(fitted)

    def score(batch: pa.RecordBatch) -> dict:
        if shared.value is None:
            found = np.zeros((batch.num_rows, 3))
            values = np.zeros(batch.num_rows)
        else:
            models, b = shared.value
            found = np.array([models.features(x.as_py()) for x in batch.column(2)])
            values = 1 / (1 + np.exp(-np.clip(found[:, 2] * b[0] + b[1], -30, 30)))
        return {
            "doc_id": batch.column(0), "held_out": batch.column(1), "score": pa.array(values),
            "predicted": pa.array((values >= threshold).astype(np.int32)),
            "ordinary_log": pa.array(found[:, 0]), "toxic_log": pa.array(found[:, 1]),
        }

    out = map_arrow(
        rows, score,
        f"doc_id {kind}, held_out boolean, score double, predicted int, ordinary_log double, "
        "toxic_log double",
    )
    return out.withColumnRenamed("doc_id", id_column)


def held_out_fold(id_column: str = "doc_id") -> Column:
    return fold(id_column, 4) == 2
