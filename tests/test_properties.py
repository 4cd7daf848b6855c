"""Operators against plain Python on generated input, with limits small enough to matter."""

from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelstat.operators import assemble_documents, chunk_ids, flatten_pages, positions, top_k_per

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
keys = st.sampled_from(["hot", "hot", "hot", "a", "b", None])


@few
@given(
    rows=st.lists(st.tuples(keys, st.integers(-(2**62), 2**62)), min_size=1, max_size=60, unique=True),
    block=st.sampled_from([1, 5, 1 << 20]),
)
def test_positions(spark, rows, block):
    frame = spark.createDataFrame(rows, "key STRING, at BIGINT")
    got = {(r.key, r.at): r.position for r in positions(frame, ["key"], "at", block=block).collect()}
    members = defaultdict(list)
    for key, at in rows:
        members[key].append(at)
    assert got == {(k, at): i for k, ats in members.items() for i, at in enumerate(sorted(ats))}


@few
@given(
    pages=st.dictionaries(
        st.tuples(keys, st.integers(0, 50)), st.lists(st.sampled_from("xyz"), max_size=4), min_size=1
    ),
    block=st.sampled_from([1, 4, 1 << 14]),
    size=st.integers(1, 5),
)
def test_pages_to_chunks(spark, pages, block, size):
    rows = [(key, page, ids) for (key, page), ids in pages.items()]
    frame = spark.createDataFrame(rows, "key STRING, page INT, ids ARRAY<STRING>")
    want = defaultdict(list)
    for key, _, ids in sorted(rows, key=lambda row: row[1]):
        want[key] += ids
    flat = flatten_pages(frame, "key", "page", "ids", block=block)
    got = {(r.key, r.position): r.videoId for r in flat.collect()}
    assert got == {(k, i): v for k, ids in want.items() for i, v in enumerate(ids)}
    chunks = {(r.key, r.chunk): r.ids for r in chunk_ids(flat, "key", "videoId", size=size).collect()}
    assert chunks == {
        (k, i // size): ",".join(ids[i : i + size])
        for k, ids in want.items()
        for i in range(0, len(ids), size)
    }


@few
@given(
    children=st.lists(st.tuples(keys, st.sampled_from("pqrs"), st.integers(0, 2)), max_size=60),
    max_items=st.integers(1, 20),
)
def test_documents_hold_every_child_once(spark, children, max_items):
    parents = spark.createDataFrame([("hot", 1), ("a", 2), ("none", 3)], "key STRING, n INT")
    frame = spark.createDataFrame(children, "key STRING, id STRING, x INT")
    docs = assemble_documents(parents, frame, "key", "items", max_items).collect()
    got = Counter((d.key, i.id, i.x) for d in docs for i in d["items"])
    assert got == Counter(c for c in children if c[0] in ("hot", "a"))
    assert {d.key: d.n for d in docs} == {"hot": 1, "a": 2, "none": 3}
    total = Counter(c[0] for c in children)
    assert Counter(d.key for d in docs) == {
        k: max(1, -(-total[k] // max_items)) for k in ("hot", "a", "none")
    }
    for d in docs:
        assert d.parts == max(1, -(-total[d.key] // max_items)) and 0 <= d.part < d.parts
        assert len(d["items"]) == min(max_items, total[d.key] - d.part * max_items)
    assert all([tuple(i) for i in d["items"]] == sorted(tuple(i) for i in d["items"]) for d in docs)


@few
@given(
    rows=st.lists(st.tuples(keys, st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=60),
    k=st.integers(1, 6),
)
def test_top_k_per(spark, rows, k):
    frame = spark.createDataFrame(rows, "key STRING, v INT, t INT").repartition(4)
    top = top_k_per(frame, ["key"], [F.desc("v"), F.col("t")], k).collect()
    want = defaultdict(list)
    for key, v, t in sorted(rows, key=lambda row: (-row[1], row[2])):
        if len(want[key]) < k:
            want[key].append((v, t))
    got = defaultdict(list)
    for r in sorted(top, key=lambda r: r.rank):
        got[r.key].append((r.v, r.t))
    assert got == want


@pytest.mark.parametrize("value", [None, "", " 12 ", "1e3", "0x1", "９", "2147483647", "2147483648"])
def test_counts_follow_the_sql_cast(spark, value):
    from reelstat.functions import count_of

    frame = spark.createDataFrame([(value,)], "s STRING")
    want = frame.selectExpr("try_cast(s AS INT)").collect()[0][0]
    assert frame.select(count_of(F.col("s"))).collect()[0][0] == want
