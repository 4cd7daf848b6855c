import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from reelstat.llm import hmm, lm

SMALL = lm.Shape(states=3, words_per_root=3, words_per_class=5, head=60, folds=3, passes=6)


def table_of(frame, seed=1, n=120):
    rng = random.Random(seed)
    kinds = [[f"{k}{i}" for i in range(60)] for k in ("en", "de")]
    rows = [
        (i, " ".join(rng.choices(rng.choice(kinds), k=rng.randint(0, 40)))) for i in range(n)
    ]
    return rows, frame("doc_id long, text string", rows)


def test_base_scores_and_counts_equal_brute_force(frame):
    rows, table = table_of(frame)
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    tokens = {i: t.lower().split() + [None] for i, t in rows}
    counts = Counter(w for i in tokens if not held[i] for w in tokens[i])
    total, distinct = sum(counts.values()), len(counts)
    for r in lm.scores(table, held_out=lm.held_out_fold(), shape=SMALL).collect():
        own = tokens[r["doc_id"]]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        assert r["held_out"] == held[r["doc_id"]]
        assert (r["n_tokens"], r["train_tokens"]) == (len(own), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in own)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)


def test_the_model_beats_single_words_on_held_out_texts(frame):
    _, table = table_of(frame, n=400)
    rows = [r for r in lm.scores(table, held_out=lm.held_out_fold(), shape=SMALL).collect() if r["held_out"]]
    assert len(rows) > 50
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def models(seed, states, symbols):
    rng = np.random.default_rng(seed)
    draw = lambda *s: (x := rng.random(s) + 0.1) / x.sum(axis=-1, keepdims=True)
    return hmm.Model(draw(states), draw(states, states), draw(states, symbols).T.copy()), rng


def plain(model, sequence):
    alpha = [model.start * model.emit[sequence[0]]]
    for x in sequence[1:]:
        alpha.append((alpha[-1] @ model.move) * model.emit[x])
    beta = [np.ones(len(model.start))]
    for x in sequence[:0:-1]:
        beta.append(model.move @ (model.emit[x] * beta[-1]))
    beta = beta[::-1]
    p = alpha[-1].sum()
    emit, move = np.zeros_like(model.emit), np.zeros_like(model.move)
    for t, x in enumerate(sequence):
        emit[x] += alpha[t] * beta[t] / p
        if t:
            move += np.outer(alpha[t - 1], model.emit[x] * beta[t]) * model.move / p
    return np.log(p), alpha[0] * beta[0] / p, move, emit


def test_lanes_change_nothing(monkeypatch):
    monkeypatch.setattr(hmm, "LANE", 4)
    monkeypatch.setattr(hmm, "TOGETHER", 3)
    model, rng = models(0, 3, 7)
    sequences = [rng.integers(0, 7, n) for n in (1, 2, 3, 4, 5, 8, 9, 13, 4, 4, 17, 1)]
    expected = [plain(model, s) for s in sequences]
    assert np.allclose(hmm.log_likelihoods(model, sequences), [x[0] for x in expected])
    found = hmm.expected_counts(model, sequences)
    assert found.log == pytest.approx(sum(x[0] for x in expected))
    assert np.allclose(found.start, sum(x[1] for x in expected))
    assert np.allclose(found.move, sum(x[2] for x in expected))
    assert np.allclose(found.emit, sum(x[3] for x in expected))


def test_a_round_over_partitions_equals_one_over_all_and_gains(spark, frame):
    model, rng = models(3, 3, 9)
    sequences = [rng.integers(0, 9, rng.integers(1, 30)) for _ in range(40)]
    rows = [(s.astype(np.uint16).tobytes(),) for s in sequences]
    found = lm.train_round(frame("symbols binary", [(bytearray(x[0]),) for x in rows], 5), model)
    whole = hmm.expected_counts(model, sequences)
    assert np.allclose(found.emit, whole.emit) and np.allclose(found.move, whole.move)
    assert found.log == pytest.approx(whole.log)
    better = hmm.expected_counts(hmm.estimate(whole, smoothing=0.0), sequences)
    assert better.log > whole.log - 1e-3


def test_each_pass_over_partitions_gains(frame):
    model, rng = models(5, 4, 30)
    rows = []
    for i in range(300):
        state, own = 0, []
        for _ in range(int(rng.integers(5, 40))):
            state = rng.choice(4, p=0.8 * np.eye(4)[state] + 0.2 * model.move[state])
            own.append(rng.choice(30, p=model.emit[:, state]))
        rows.append((i % 3, bytearray(np.array(own, dtype=np.uint16).tobytes())))
    texts = frame("fold int, symbols binary", rows, 4)
    counts = np.bincount(np.concatenate([np.frombuffer(x, np.uint16) for _, x in rows]), minlength=30)
    shape = lm.Shape(states=4, folds=3, passes=8, tolerance=0.0)
    _, passes = lm.train(texts, counts.astype(float), shape)
    # Smoothing is part of what is maximised, so the likelihood may fall by a trifle.
    assert len(passes) >= 5
    assert all(b > a - 1e-4 * abs(a) for a, b in zip(passes, passes[1:]))
    assert passes[-1] > passes[0] + 0.002 * abs(passes[0])
    _, again = lm.train(texts, counts.astype(float), lm.Shape(states=4, folds=3, passes=8, tolerance=0.5))
    assert len(again) == 2


def test_symbols_grow_with_the_corpus():
    shape = lm.Shape()
    assert [shape.words(x) for x in (0, 1000, 10**9)] == [0, 500, 50_000]
    words = np.arange(1, 120_001, dtype=np.uint64)
    head = (words, np.arange(120_000) % 7, np.full(120_000, 100_000))
    big = lm.Lexicon(head, [(k, 19 * 10**8, 20_000) for k in range(7)], 10, shape)
    assert big.own == shape.words(133 * 10**8 + 10) and big.kind == np.uint32
    small = lm.Lexicon(tuple(x[:50] for x in head), [(0, 4 * 10**6, 50)], 10, shape)
    assert small.own == 50 and small.kind == np.uint16


def test_edges(frame):
    rows = [(1, "a b"), (1, "a b"), (None, "A\u000bb"), (3, None), (4, ""), (5, "x" * 100_000 + " a")]
    table = frame("doc_id long, text string, score int", [(*r, 1) for r in rows])
    found = lm.scores(table, shape=SMALL)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = {r["doc_id"]: r for r in found.collect()}
    assert found.count() == 6
    assert (got[3]["n_tokens"], got[4]["score"]) == (1, got[3]["score"])
    assert got[1]["score"] == got[None]["score"] and got[1]["train_tokens"] == 14
    assert lm.scores(table.limit(0), shape=SMALL).count() == 0
    from pyspark.sql import functions as F

    nothing = lm.scores(table, held_out=F.lit(True), shape=SMALL).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in nothing} == {(0, 0)}
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in nothing)


def test_the_head_is_bounded(frame):
    counts = frame("word long, last int, n long", [(i, 0, 1 + i) for i in range(1000)])
    words, _, n = lm.most_frequent(counts, 100)
    assert 50 <= len(words) <= 100 and list(n) == sorted(n, reverse=True) and n[0] == 1000
    assert len(lm.most_frequent(counts.limit(0), 100)[0]) == 0
