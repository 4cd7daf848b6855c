import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelstat.llm import repeats
from reelstat.llm.repeats import Bucket, Limits

LENGTH = 30


def brute(texts, length):
    """By id and text the result of looking at every string of ``length`` bytes."""
    seen, out = set(), {}
    for i, text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            part = data[s : s + length]
            if part in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(part)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


def mixed(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(6, 40))) for _ in range(8)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            if kind < 0.5:
                passage = rng.choice(passages)
                a = rng.randrange(len(passage))
                parts.append(passage[a:] if rng.random() < 0.5 else passage[:a])
            elif kind < 0.9:
                parts.append(" ".join(word() for _ in range(rng.randint(1, 30))))
            else:
                parts.append(rng.choice(["a", "ab", "abc "]) * rng.randint(10, 80))
        texts.append(" ".join(parts))
    return list(enumerate(texts))


def result(frame, texts, **options):
    table = frame("doc_id long, text string", texts)
    rows = repeats.remove_repeats(table, length=LENGTH, **options).collect()
    return {r[0]: tuple(r[1:5]) for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(frame, seed):
    texts = mixed(seed)
    assert result(frame, texts) == brute(texts, LENGTH)


def test_large_buckets_equal_brute_force(frame):
    texts = mixed(3)
    assert result(frame, texts, limits=Limits(bucket=1)) == brute(texts, LENGTH)
    assert result(frame, texts, limits=Limits(chunk=1)) == brute(texts, LENGTH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=14).map(lambda x: bytes(97 + c % 2 for c in x)), max_size=6))
def test_intervals_are_all_groups_of_equal_prefixes(found):
    suffixes = sorted(found)
    shared = [0]
    for a, b in zip(suffixes, suffixes[1:]):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        shared.append(n)
    got = set(repeats.intervals(shared[: len(suffixes)], 2))
    expected = set()
    for depth in range(2, 15):
        for first in range(len(suffixes)):
            last = first
            while last + 1 < len(suffixes) and shared[last + 1] >= depth:
                last += 1
            whole = not first or shared[first] < depth
            if whole and last > first and min(shared[first + 1 : last + 1]) == depth:
                expected.add((depth, first, last))
    assert got == expected


def test_groups_are_maximal_and_complete():
    core = bytes(random.Random(1).choices(range(33, 127), k=40))
    rows = [(d, d, 0, 0, bytes([65 + d]) * 3 + core + bytes([97 + d]) * 3) for d in range(4)]
    found = list(Bucket(rows, 30).groups())
    assert found == [(40, [(d, d, 3) for d in range(4)])]


def test_self_repeats_and_periods(frame):
    texts = [(0, "ab" * 200), (1, "x" * 500), (2, "x" * 40), (3, "word " * 60)]
    assert result(frame, texts) == brute(texts, LENGTH)


def test_edges(frame):
    long = "some text that is long enough to be found again elsewhere"
    rows = [(5, long, "n"), (5, long, "n"), (None, long, "n"), (7, None, "n"), (8, "", "n"), (9, "short", "n")]
    table = frame("doc_id long, text string, n_bytes string", rows)
    out = repeats.remove_repeats(table, length=LENGTH, with_bytes=True)
    found = sorted((r["doc_id"] is None, r["doc_id"], r["n_removed"]) for r in out.collect())
    assert found == [
        (False, 5, len(long)), (False, 5, len(long)), (False, 7, 0), (False, 8, 0), (False, 9, 0),
        (True, None, 0),
    ]
    assert repeats.remove_repeats(table.limit(0), length=LENGTH).count() == 0
    # Two texts under one id: one of them keeps what they share.
    rows = [(1, long + " one"), (1, long + " two")]
    out = repeats.remove_repeats(frame("doc_id long, text string", rows), length=LENGTH).collect()
    assert sorted(r["n_removed"] for r in out) == [0, len(long) + 1]


def test_groups_of_a_corpus(frame):
    passage = "a passage that several documents share word by word for sure"
    rows = [(i, f"{i * 7919} unlike {passage} and {i * 104729} more") for i in range(5)]
    table = frame("doc_id long, text string", rows)
    search = repeats.Repeats(table, "doc_id", "text", LENGTH, Limits())
    groups = search.groups().collect()
    covered = {}
    for r in groups:
        covered.setdefault(r["doc_id"], set()).update(range(r["start"], r["start"] + r["length"]))
    for i, text in rows:
        at = text.index(passage)
        assert set(range(at, at + len(passage))) <= covered[i]


def test_texts_beyond_the_places_of_an_anchor_equal_brute_force(frame):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    base = " ".join(word() for _ in range(2500))
    assert len(base) > 3 * 4096
    texts = [(0, base), (1, base[5000:9000] + base[100:400]), (2, "ab" * 3000), (3, "x" * 9000 + base[:50]), (4, "x" * 4200)]
    assert result(frame, texts) == brute(texts, LENGTH)


def listed_groups(frame, texts, limits):
    search = repeats.Repeats(frame("doc_id long, text string", texts), "doc_id", "text", LENGTH, limits)
    found = {}
    for r in search.groups().collect():
        found.setdefault((r["group"], r["length"]), set()).add((r["doc_id"], r["start"]))
    return {(length, frozenset(x)) for (_, length), x in found.items()}


def test_split_buckets_give_the_same_groups(frame):
    texts = [(i, t) for i, t in mixed(5)[:40]]
    whole = listed_groups(frame, texts, Limits())
    assert whole == listed_groups(frame, texts, Limits(bucket=1)) == listed_groups(frame, texts, Limits(bucket=3))
    data = dict(texts)
    for length, places in whole:
        parts = {data[i].encode()[start : start + length] for i, start in places}
        assert len(parts) == 1 and len(next(iter(parts))) == length >= LENGTH and len(places) > 1


def test_groups_hold_every_string_that_occurs_twice(frame):
    texts = [(i, t) for i, t in mixed(6)[:40]]
    groups = listed_groups(frame, texts, Limits(bucket=2))
    places = {}
    for i, text in texts:
        data = text.encode()
        for s in range(len(data) - LENGTH + 1):
            places.setdefault(data[s : s + LENGTH], set()).add((i, s))
    inside = {}
    for length, found in groups:
        for i, start in found:
            for k in range(start, start + length - LENGTH + 1):
                inside.setdefault((i, k), []).append((length, found, k - start))
    for own in places.values():
        if len(own) > 1:
            # Some group has all of its occurrences, at one distance from where the group begins.
            i, s = min(own)
            assert any(own == {(j, p + k) for j, p in found} for _, found, k in inside.get((i, s), [])), own
