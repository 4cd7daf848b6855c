import random
import zlib

import numpy as np
import pytest

from reelstat.llm import toxicity

BAD = ["badword", "vileness", "slurs", "filthier"]


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(8, 60))]
        toxic = int(rng.random() < 0.3)
        for _ in range(toxic * rng.randint(2, 4)):
            text.insert(rng.randrange(len(text)), rng.choice(BAD))
        rows.append((i, " ".join(text), toxic))
    return rows


def test_held_out_accuracy(frame):
    rows = corpus(900)
    docs = frame("doc_id long, text string", [r[:2] for r in rows])
    labels = frame("doc_id long, toxic int", [(r[0], r[2]) for r in rows if r[0] % 10])
    found = toxicity.scores(docs, labels, held_out=toxicity.held_out_fold()).collect()
    truth = {r[0]: r[2] for r in rows}
    assert len(found) == 900
    out = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in out} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in out)
    assert right >= 0.95 * len(out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)


def test_held_out_labels_change_nothing(frame):
    rows = corpus(300)
    docs = frame("doc_id long, text string", [r[:2] for r in rows])
    held = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2}
    scores = []
    for flip in (False, True):
        own = [(i, 1 - t if flip and i in held else t) for i, _, t in rows]
        labels = frame("doc_id long, toxic int", own)
        out = toxicity.scores(docs, labels, held_out=toxicity.held_out_fold())
        scores.append({r["doc_id"]: round(r["score"], 9) for r in out.collect()})
    assert scores[0] == scores[1]


def test_probabilities_of_each_context_sum_to_one():
    rng = np.random.default_rng(1)
    words = rng.integers(1, 12, 4000).astype(np.uint64)
    context = toxicity.contexts_of(words)
    pairs, at = np.unique(np.stack((context, words, words), 1), axis=0, return_inverse=True)
    label = rng.integers(0, 2, 4000)
    counts = np.stack([np.bincount(at.ravel(), label == k, len(pairs)) for k in (0, 1)], 1)
    model = toxicity.Models(*np.ascontiguousarray(pairs.T), counts)
    known = np.arange(1, 12, dtype=np.uint64)
    for before in [5, 11, 999]:
        total = np.zeros(2)
        for word in [*known, np.uint64(777)]:
            pair = np.array([before, word], dtype=np.uint64)
            total += np.exp(model.logs(pair, pair)[1].astype(float))
        assert total == pytest.approx([1.0, 1.0], abs=1e-4)


def test_logistic_regression_finds_the_slope():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(5000, 1))
    y = (rng.random(5000) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))).astype(float)
    slope, intercept = toxicity.logistic(x, y, np.ones(5000))
    assert slope == pytest.approx(2, abs=0.2) and intercept == pytest.approx(-1, abs=0.2)
    assert np.isfinite(toxicity.logistic(np.zeros((4, 2)), np.array([0, 0, 1, 1.0]), np.ones(4))).all()


def test_edges(frame):
    rows = corpus(200)
    extra = [(None, None), (1000, None), (1001, ""), (1002, "badword " * 50_000)]
    docs = frame("doc_id long, text string, score int", [(*r[:2], 1) for r in rows] + [(*x, 1) for x in extra])
    labels = frame(
        "doc_id long, toxic int, text int",
        [(r[0], r[2], 0) for r in rows] + [(None, 1, 0), (1000, None, 0), (1, 0, 0), (1, 1, 0)],
    )
    got = {r["doc_id"]: r for r in toxicity.scores(docs, labels).collect()}
    assert len(got) == 204
    assert got[None]["score"] == got[1000]["score"] == got[1001]["score"] < 0.5
    assert got[1002]["predicted"] == 1
    assert toxicity.scores(docs.limit(0), labels).count() == 0
    for none in (labels.limit(0), labels.filter("toxic = 1")):
        assert {r["score"] for r in toxicity.scores(docs, none).collect()} == {0.0}


def plain_models(pairs):
    """{(context, word): [P by ordinary, P by toxic]} from a list of (context, word, class), by the
    definition, for words that all occur three times at least."""
    words = sorted({w for _, w, _ in pairs})
    count = lambda keep: [sum(1 for p in pairs if keep(p) and p[2] == k) for k in (0, 1)]
    total = count(lambda p: True)

    def chance(own):
        n, ratio = sum(own), 0.0
        for k in (0, 1):
            if own[k]:
                ratio += 2 * own[k] * np.log(own[k] / (n * total[k] / sum(total)))
        return ratio < 10.8

    kinds = sorted({p[:2] for p in pairs})
    of_pair = {x: count(lambda p: p[:2] == x) for x in kinds}
    of_word = {w: count(lambda p: p[1] == w) for w in words}
    sums = [sum(x) for x in of_pair.values()]
    once, twice = sums.count(1), sums.count(2)
    d = once / (once + 2 * twice) if once else 0.5
    pooled = {w: sum(x[1] == w for x in kinds) for w in words}
    types, slots = sum(pooled.values()), len(words) + 1  # one place is for unknown words
    shared = {w: max(pooled[w] - d, 0) / types + d * len(words) / types / slots for w in words}
    out = {}
    for k in (0, 1):
        part = total[k] / sum(total)
        follows, less = {}, {}
        for w in words:
            if chance(of_word[w]):
                follows[w], less[w] = pooled[w] * part, d * part
            else:
                follows[w], less[w] = sum(x[1] == w and of_pair[x][k] > 0 for x in kinds), d
        mass = sum(follows.values())
        held = {w: max(follows[w] - less[w], 0) / mass for w in words}
        lower = {w: held[w] + (1 - sum(held.values())) * shared[w] for w in words}
        counts, cut = {}, {}
        for x in kinds:
            n = sum(of_pair[x])
            if not chance(of_pair[x]):
                counts[x], cut[x] = of_pair[x][k], d
            else:
                own = of_word[x[1]]
                ratio = part if chance(own) else own[k] / sum(own)
                counts[x], cut[x] = n * ratio, d * ratio
        for before in {x[0] for x in kinds}:
            here = [x for x in kinds if x[0] == before]
            all_of = sum(counts[x] for x in here)
            kept = {x[1]: max(counts[x] - cut[x], 0) / all_of for x in here if sum(of_pair[x]) >= 3} if all_of else {}
            for w in words:
                p = kept.get(w, 0) + (1 - sum(kept.values())) * lower[w]
                out.setdefault((before, w), []).append(p)
    return out


def test_probabilities_equal_the_definition():
    rng = np.random.default_rng(4)
    label = (rng.random(1500) < 0.3).astype(int)
    words = np.where((label == 1) & (rng.random(1500) < 0.15), 9, rng.integers(1, 9, 1500)).astype(np.uint64)
    context = np.concatenate((words[-1:], words[:-1]))
    found, at = np.unique(np.stack((context, words, words), 1), axis=0, return_inverse=True)
    counts = np.stack([np.bincount(at.ravel(), label == k, len(found)) for k in (0, 1)], 1)
    model = toxicity.Models(*np.ascontiguousarray(found.T), counts)
    wanted = plain_models([(int(c), int(w), int(k)) for c, w, k in zip(context, words, label)])
    for (before, word), p in wanted.items():
        pair = np.array([before, word], dtype=np.uint64)
        assert np.exp(model.logs(pair, pair)[1].astype(float)) == pytest.approx(p, rel=1e-4)


def test_words_that_chance_explains_weigh_nothing(frame):
    rows = corpus(600)
    docs = frame("doc_id long, text string", [*[r[:2] for r in rows], (10_000, " ".join(f"word{i}" for i in range(300)))])
    labels = frame("doc_id long, toxic int", [(r[0], r[2]) for r in rows])
    got = {r["doc_id"]: r for r in toxicity.scores(docs, labels).collect()}
    assert -0.2 < got[10_000]["toxic_log"] - got[10_000]["ordinary_log"] < 0.02
    assert got[10_000]["predicted"] == 0


def test_repeated_rows_and_texts_beyond_the_bound(frame):
    rows = corpus(300)
    long_text = "newbadword " * 200
    docs = frame("doc_id long, text string", [r[:2] for r in rows] * 2 + [(9000, long_text), (9001, "newbadword here")])
    labels = frame("doc_id long, toxic int", [(r[0], r[2]) for r in rows] + [(9000, 1)])
    scored = toxicity.scores(docs, labels, bounds=toxicity.Fit(max_bytes=1000)).collect()
    by_id = {}
    for r in scored:
        by_id.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(scored) == 602 and all(len(x) == 1 for x in by_id.values())
    once = {r["doc_id"]: r["score"] for r in toxicity.scores(docs.dropDuplicates(), labels, bounds=toxicity.Fit(max_bytes=1000)).collect()}
    assert all(once[i] == pytest.approx(next(iter(x)), abs=1e-9) for i, x in by_id.items())
