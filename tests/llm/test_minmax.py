import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelstat.llm import minmax
from reelstat.llm.common import mix


def brute(texts, n, percent):
    """{id: (size of its set, component)} by comparing all pairs."""
    sets = {}
    for i, text in texts.items():
        words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} - {()})
    component = {i: i for i in texts}
    changed = True
    links = [
        (i, j) for i in texts for j in texts
        if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    while changed:
        changed = False
        for i, j in links:
            low = min(component[i], component[j])
            changed |= component[i] != low or component[j] != low
            component[i] = component[j] = low
    return {i: (len(sets[i]), component[i]) for i in texts}


def variants(seed, groups, copies, length):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(*length))
        for _ in range(rng.randint(1, copies)):
            other = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            texts.append(" ".join(other))
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize(
    ("n", "percent", "length"), [(5, 85, (3, 90)), (5, 80, (40, 300)), (1, 85, (5, 60))]
)
def test_components_equal_brute_force(frame, n, percent, length):
    texts = variants(n, 25, 12, length)
    table = frame("doc_id long, text string", list(texts.items()))
    found = minmax.near_duplicates(table, n=n, percent=percent).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == brute(texts, n, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_chain_whose_ends_are_not_linked(frame):
    words = [f"w{i}" for i in range(80)]
    texts = {i: " ".join(words[i : i + 60]) for i in range(16)}
    found = minmax.near_duplicates(frame("doc_id long, text string", list(texts.items())), n=4, percent=85)
    assert {r[0]: (r[1], r[2]) for r in found.collect()} == brute(texts, 4, 85)


def test_links_that_do_not_pass_through_the_smallest_document(frame):
    # One bucket holds two groups that are linked inside but not with each other.
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for group in range(2):
        own = [f"g{group}" if k % 14 == group else w for k, w in enumerate(base)]
        for _ in range(12):
            other = list(own)
            other[rng.randrange(120)] = "x"
            texts[len(texts)] = " ".join(other)
    wide = minmax.Bands(permutations=64, values=1)
    found = minmax.near_duplicates(
        frame("doc_id long, text string", list(texts.items())), n=1, percent=95, bands=wide
    )
    assert {r[0]: (r[1], r[2]) for r in found.collect()} == brute(texts, 1, 95)


def test_minima_and_maxima_estimate_the_similarity():
    rng = np.random.default_rng(0)
    bands = minmax.Bands()
    errors = {"both": [], "minima": []}
    for share in (0.2, 0.5, 0.8, 0.85, 0.95):
        for _ in range(60):
            pool = mix(rng.integers(1, 1 << 62, 400).astype(np.uint64))
            same = int(share * 200)
            a, b = pool[:200], np.concatenate((pool[:same], pool[200 : 400 - same]))
            true = same / (400 - same)
            x, y = minmax.signatures([np.sort(a), np.sort(b)], bands)
            errors["both"].append(minmax.similarity(x, y) - true)
            errors["minima"].append(minmax.similarity(x[:96], y[:96]) - true)
    assert abs(np.mean(errors["both"])) < 0.005
    assert np.std(errors["both"]) < 0.85 * np.std(errors["minima"])


def test_signature_is_of_all_hashes():
    bands = minmax.Bands(permutations=3)
    sets = [np.arange(1, k, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for k in (2, 70_000, 5, 300)]
    found = minmax.signatures(sets, bands)
    for own, row in zip(sets, found):
        for i, factor in enumerate(bands.multipliers()):
            hashes = own * factor
            hashes ^= hashes >> np.uint64(29)
            assert row[i] == hashes.min() and row[3 + i] == hashes.max()


def test_edges(frame):
    rows = [
        (0, "Same text here now ok", "x"), (0, "Same text here now ok", "x"), (1, "SAME text here now ok", "y"),
        (2, None, "z"), (3, "", "z"), (4, "  \n", "z"), (None, "same text here now ok", "z"), (None, None, "z"),
        (5, "one two", "z"), (6, "One TWO", "z"), (7, "one", "z"), (8, "ä b c d", "z"), (9, "Ä b c d", "z"),
    ]
    table = frame("doc_id long, text string, key string", rows)
    table = table.withColumns({"component_id": F.lit("own"), "n_shingles": F.lit("own"), "kept": F.lit("own")})
    found = minmax.near_duplicates(table, percent=85).collect()
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted((tuple(r) for r in found), key=order) == [
        (0, 1, 0, True), (0, 1, 0, True), (1, 1, 0, False), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True),
        (5, 1, 5, True), (6, 1, 5, False), (7, 1, 7, True), (8, 1, 8, True), (9, 1, 9, True),
        (None, 0, None, True), (None, 1, None, True),
    ]
    assert minmax.near_duplicates(table.limit(0)).count() == 0
    kept = minmax.drop_near_duplicates(table)
    assert kept.columns == table.columns
    assert sorted(r[0] for r in kept.collect() if r[0] is not None) == [0, 0, 2, 3, 4, 5, 7, 8, 9]


def test_rows_with_the_same_id_share_a_component(frame):
    rows = [(5, "a b c d e"), (5, "v w x y z"), (3, "v w x y z"), (9, "a b c d e"), (7, "other words than these ones")]
    found = minmax.near_duplicates(frame("doc_id long, text string", rows)).collect()
    assert {(r[0], r[2]) for r in found} == {(5, 3), (3, 3), (9, 3), (7, 7)}


def test_large_groups_and_a_very_long_text(frame):
    text = " ".join(f"w{i}" for i in range(60))
    long_text = " ".join(f"v{i}" for i in range(30_000))
    rows = [(i, text if i % 3 else f"{text} x{i}") for i in range(900)]
    rows += [(1000, long_text), (1001, long_text + " more"), (1002, "v1 v2 v3 v4 v5")]
    found = minmax.near_duplicates(frame("doc_id long, text string", rows), percent=85).collect()
    assert {r["component_id"] for r in found if r["doc_id"] < 900} == {0}
    assert {r["doc_id"]: r["component_id"] for r in found if r["doc_id"] >= 1000} == {1000: 1000, 1001: 1000, 1002: 1002}
