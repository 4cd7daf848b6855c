import random
import zlib

import pytest

from reelstat.llm import shards


def sizes_of(rows):
    out = {}
    for r in rows:
        out[r["shard"]] = out.get(r["shard"], 0) + len((r["text"] or "").encode()) + 16
    return out


def check(rows, n_shards, biggest):
    sizes = sizes_of(rows)
    total = sum(sizes.values())
    for shard in range(n_shards):
        assert abs(sizes.get(shard, 0) - total / n_shards) <= biggest + 0.002 * total / n_shards
    for shard in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(
            range(sum(r["shard"] == shard for r in rows))
        )


def test_sizes_are_near_equal_and_slots_gapless(frame):
    rng = random.Random(2)
    rows = [(i, "x" * rng.randrange(200) + str(rng.random()), 7) for i in range(3000)]
    table = frame("doc_id long, text string, shard int", rows)
    out = shards.shard_documents(table, 12)
    assert out.columns == ["doc_id", "text", "shard", "slot"]
    found = out.collect()
    assert len(found) == 3000
    check(found, 12, 240)


def test_a_group_of_equal_texts_is_split_only_where_it_is_larger_than_a_shard(frame):
    rows = [(i, "same text" if i % 3 else f"other {i}") for i in range(3000)]
    found = shards.shard_documents(frame("doc_id long, text string", rows), 10).collect()
    check(found, 10, 40)
    of = sorted({r["shard"] for r in found if r["text"] == "same text"})
    assert of == list(range(of[0], of[-1] + 1)) and 6 <= len(of) <= 8


def test_rows_come_in_the_order_of_their_keys(frame):
    rows = [(i, f"t{i}") for i in range(500)]
    found = shards.shard_documents(frame("doc_id long, text string", rows), 4).collect()
    ordered = sorted(found, key=lambda r: (r["shard"], r["slot"]))
    sums = [zlib.crc32(r["text"].encode()) for r in ordered]
    assert sums == sorted(sums)


def test_splitters_equal_brute_force(frame):
    rng = random.Random(4)
    keys = sorted(rng.randrange(1 << 62) for _ in range(400))
    rows = [(k, rng.randrange(1, 50)) for k in keys]
    total = sum(s for _, s in rows)
    found = shards.find_splitters(frame("key long, size long", rows), 7, total, tolerance=0.0)
    for i, (key, below) in enumerate(zip(found.keys, found.below), 1):
        assert below == sum(s for k, s in rows if k < key)
        best = min(abs(sum(s for k, s in rows if k < cut) - total * i // 7) for cut in [*keys, 1 << 62])
        assert abs(below - total * i // 7) == best
    assert found.rounds <= 13


@pytest.mark.parametrize("rows", [
    [], [(None, None)], [(1, None), (1, None), (None, "")], [(1, "a")] * 5,
])
def test_edges(frame, rows):
    table = frame("doc_id long, text string", rows, 2)
    found = shards.shard_documents(table, 40).collect()
    assert len(found) == len(rows)
    assert len({(r["shard"], r["slot"]) for r in found}) == len(rows)
    measured = shards.shard_documents(table, 40, measures=True)
    assert measured.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    for r in measured.collect():
        assert r["size"] >= 16 and r["text_crc32"] >= 0


def test_one_very_long_text(frame):
    rows = [(0, "z" * 2_000_000), *[(i, f"t{i}") for i in range(1, 100)]]
    found = shards.shard_documents(frame("doc_id long, text string", rows), 4).collect()
    assert len(found) == 100
