import random
import time

import numpy as np

from reelstat.llm import decontaminate
from reelstat.llm.decontaminate import Index, best_stretch

RNG = random.Random(5)
ITEM = [f"t{i}" for i in range(30)]


def noise(n):
    return [f"n{RNG.randrange(10**6)}" for _ in range(n)]


def tables(frame, texts, items):
    docs = frame("doc_id long, text string, item_id string", [(i, t, "c") for i, t in enumerate(texts)])
    return docs, frame("item_id long, text string, doc_id int", [(i, t, 7) for i, t in enumerate(items)])


def test_exact_and_substituted_passages_are_found_and_others_are_not(frame):
    every = {k: [w if i % k else "changed" for i, w in enumerate(ITEM, 1)] for k in (4, 5, 7)}
    texts = [
        noise(50) + ITEM + noise(50), ITEM, noise(5) + every[4] + noise(9), noise(3) + every[5],
        noise(40) + every[7] + noise(40), noise(200), noise(10) + ITEM[:8] + noise(10),
    ]
    docs, items = tables(frame, [" ".join(x) for x in texts], [" ".join(ITEM), "short one", ""])
    found = {r["doc_id"]: r for r in decontaminate.contaminated(docs, items).collect()}
    assert sorted(found) == [0, 1, 2, 3, 4]
    assert (found[0]["n_equal"], found[0]["doc_start"], found[0]["item_start"]) == (30, 50, 0)
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns and sorted(r[0] for r in kept.collect()) == [5, 6]


def test_case_and_punctuation_do_not_hide_a_passage(frame):
    text = ", ".join(x.upper() for x in ITEM) + "!"
    docs, items = tables(frame, [text], [" ".join(ITEM)])
    assert decontaminate.contaminated(docs, items).count() == 1


def plain_stretch(equal, penalty):
    """(start, end) of the stretch with the highest score by trying all."""
    scores = {}
    for start in range(len(equal) + 1):
        score = 0.0
        scores[start, start] = 0.0
        for end in range(start, len(equal)):
            score += 1.0 if equal[end] else -penalty
            scores[start, end + 1] = score
    top = max(scores.values())
    end, start = min((e, s) for (s, e), x in scores.items() if x == top)
    return start, max(e for (s, e), x in scores.items() if s == start and x == top)


def plain_matches(words, items, penalty, share, least, most):
    """{item: (equal tokens, length, start in the text, start in the item)} by trying all offsets."""
    found = {}
    for k, item in enumerate(items):
        best = (0,)
        for offset in range(-len(item) + 1, len(words)):
            low, high = max(0, -offset), min(len(item), len(words) - offset)
            equal = [words[i + offset] == item[i] for i in range(low, high)]
            start, end = plain_stretch(equal, penalty)
            if sum(equal[start:end]) > best[0]:
                best = (sum(equal[start:end]), end - start, low + offset + start, low + start)
        if len(item) < least:
            needed = len(item) if 2 * len(item) >= len(words) else len(item) + 1
        else:
            needed = min(most, max(-(-share * len(item) // 1), least))
        if best[0] >= needed:
            found[k] = best
    return found


def search_all(words, items, index):
    found = index.matches(" ".join(words).encode(), decontaminate.LEAK)
    assert found == plain_matches(words, items, 1.0, 0.6, 6, 12), words


def test_hits_equal_a_search_of_all_offsets():
    items = [noise(RNG.randint(3, 25)) for _ in range(12)]
    index = Index([(i, " ".join(x).encode()) for i, x in enumerate(items)])
    for _ in range(40):
        part = list(RNG.choice(items))
        for _ in range(RNG.randrange(0, 3)):
            part[RNG.randrange(len(part))] = "other"
        search_all(noise(RNG.randrange(20)) + part + noise(RNG.randrange(20)), items, index)


def test_repeated_words_equal_a_search_of_all_offsets(monkeypatch):
    items = [["a"] * 9, ["a", "b"] * 6, ["a", "a", "c"] * 4, ["a"] * 5 + ["d"] * 5]
    index = Index([(i, " ".join(x).encode()) for i, x in enumerate(items)])
    texts = [RNG.choices("aaab", k=30) for _ in range(8)] + [["a"] * 25, ["a", "b"] * 14, ["d"] * 6 + ["a"] * 20]
    whole = [index.matches(" ".join(x).encode(), decontaminate.LEAK) for x in texts]
    monkeypatch.setattr(decontaminate, "HITS", 10)
    monkeypatch.setattr(decontaminate, "CELLS", 40)
    for words, other in zip(texts, whole):
        assert index.matches(" ".join(words).encode(), decontaminate.LEAK) == other
        # Irregular replacements may leave an offset without a seed; what is found is right.
        everything = plain_matches(words, items, 1.0, 0.6, 6, 12)
        assert all(everything[k][0] >= x[0] for k, x in other.items())
    for words in texts[8:]:
        search_all(words, items, index)


def test_one_word_repeated_is_bounded():
    items = [(i, b"same " * 30) for i in range(20)]
    index = Index(items)
    began = time.process_time()
    found = index.matches(b"same " * 20_000, decontaminate.LEAK)
    assert time.process_time() - began < 4
    assert found == {i: (30, 30, 0, 0) for i in range(20)}


def test_stretches_equal_all_stretches():
    for _ in range(300):
        equal = np.array([RNG.random() < 0.7 for _ in range(RNG.randint(1, 20))])
        for penalty in (1.0, 2.0):
            assert best_stretch(equal, penalty) == plain_stretch(equal.tolist(), penalty)


def test_blocks_give_the_same_rows(frame):
    texts = [" ".join(noise(20) + ITEM) for _ in range(5)]
    docs, items = tables(frame, texts, [" ".join(ITEM[k:]) for k in range(8)])
    whole = decontaminate.contaminated(docs, items).collect()
    parts = decontaminate.contaminated(docs, items, block_bytes=100).collect()
    assert sorted(whole) == sorted(parts) and len(whole) == 40


def test_edges(frame):
    docs, items = tables(frame, [None, "", " ".join(ITEM)], [None, "", " ".join(ITEM)])
    both = docs.unionAll(docs)
    assert [r["doc_id"] for r in decontaminate.contaminated(both, items).collect()] == [2]
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.decontaminate(docs, items).count() == 2
    unnamed = frame("doc_id long, text string", [(None, " ".join(ITEM)), (1, "x")])
    assert [r[0] for r in decontaminate.decontaminate(unnamed, items).collect()] == [1]
    long = " ".join(noise(200_000) + ITEM)
    docs, items = tables(frame, [long], [" ".join(ITEM)])
    assert decontaminate.contaminated(docs, items).first()["doc_start"] == 200_000


def test_every_distance_of_substitution_is_found(frame):
    texts, wanted = [], []
    for n in (8, 12, 15, 20, 59):
        words = [f"i{n}x{k}" for k in range(n)]
        for step in range(3, 13):
            for phase in range(step):
                changed = [w if k % step != phase else "other" for k, w in enumerate(words)]
                if sum(w != "other" for w in changed) < max(6, 0.6 * n):
                    continue
                texts.append(noise(30) + changed + noise(30))
                wanted.append(n)
    items = [" ".join(f"i{n}x{k}" for k in range(n)) for n in (8, 12, 15, 20, 59)]
    docs, items = tables(frame, [" ".join(x) for x in texts], items)
    rows = decontaminate.contaminated(docs, items).collect()
    assert len(texts) > 300 and sorted(r["doc_id"] for r in rows) == list(range(len(texts)))


def test_short_items_tolerate_a_replaced_word_and_four_of_fifteen(frame):
    short, item = [f"s{k}" for k in range(10)], ITEM[:15]
    texts = [noise(20) + short[:k] + ["x"] + short[k + 1 :] + noise(20) for k in range(10)]
    texts += [noise(20) + [w if k not in (2, 5, 9, 12) else "x" for k, w in enumerate(item)] + noise(20)]
    docs, items = tables(frame, [" ".join(x) for x in texts], [" ".join(short), " ".join(item)])
    assert sorted(r["doc_id"] for r in decontaminate.contaminated(docs, items).collect()) == list(range(11))


def test_items_of_a_few_tokens_take_no_document_that_merely_holds_them(frame):
    texts = ["so it is the end of a long and clean document", "It is.", "is it clean or is it not"]
    docs, items = tables(frame, texts, ["it is", "the", "clean"])
    rows = decontaminate.contaminated(docs, items).collect()
    assert [(r["doc_id"], r["item_id"]) for r in rows] == [(1, 0)]
