"""Quarantine, unknown fields, versions, states of reports, compaction, token chains and rules."""

import json
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reelstat import schemas, sinks, sources
from reelstat.operators import chain_positions, flatten_chain
from reelstat.plans import reports, states
from reelstat.plans.rules import Rule, visible
from reelstat.streaming import committed, ingest_landing


def doc(name="a", views=("1",), month="2024-01", **more):
    videos = [{"title": f"t{i}", "publishedAt": f"{month}-02T03:04:05Z", "viewCount": v} for i, v in enumerate(views)]
    return {"channelName": name, "subscribers": "1", "totalVideos": "1", "videos": videos} | more


def land(zone, name, *lines):
    os.makedirs(zone, exist_ok=True)
    Path(zone, name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


# ---------------------------------------------------------------- quarantine and unknown fields

BAD = {
    '{"channelName":"x","videos":[': "malformed", "plain words": "malformed", "[1, 2]": "wrong type",
    "7": "wrong type", '{"channelName":"x","videos":"none"}': "wrong type",
    '{"channelName":{"a":1},"videos":[]}': None, '{"videos":[]}': "no channel name", "{}": "no channel name",
}


def test_every_line_is_a_document_or_quarantined(spark, folder):
    zone = folder()
    land(zone, "1.json", doc("a"), *BAD, "", "   ")
    land(zone, "2.json", doc("b", views=()))
    checked = sources.checked_landing(spark, zone).cache()
    good, bad = sources.documents_of(checked), sources.quarantined(checked)
    reasons = {r.value: r.reason for r in bad.collect()}
    assert reasons == {line: reason for line, reason in BAD.items() if reason}
    assert all(r.source.endswith("1.json") for r in bad.collect())
    assert good.schema == schemas.landing()
    assert sorted(r.channelName for r in good.collect()) == ["a", "b", '{"a":1}']
    assert good.count() + bad.count() == checked.count() == 2 + len(BAD)
    checked.unpersist()


def test_quarantine_in_a_stream(spark, folder):
    zone, out = folder(), folder("out")
    land(zone, "1.json", doc("a"), "broken", doc("b"))
    lines = sources.checked_landing(spark, zone, stream=True)
    assert lines.isStreaming
    query = sources.quarantined(lines).writeStream.format("parquet").option(
        "checkpointLocation", folder("check")
    ).trigger(availableNow=True).start(out)
    query.awaitTermination()
    assert [r.value for r in spark.read.parquet(out).collect()] == ["broken"]


def test_ingestion_with_quarantine_counts_each_line_once(spark, folder, database, monkeypatch):
    zone, checkpoint, bad = folder(), folder("check"), folder("bad")
    table = f"{database}.curated"
    run = lambda: ingest_landing(spark, zone, table, checkpoint, delete=True, quarantine=bad)
    land(zone, "1.json", doc("a", ["1", "2"]), "broken")
    with monkeypatch.context() as patch:
        patch.setattr("reelstat.streaming.incremental.show_batches", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    assert run() == 1
    land(zone, "1.json", "broken too")
    assert run() == 1 and run() == 0
    assert spark.table(table).count() == 2
    assert sorted(r.value for r in spark.read.parquet(bad).collect()) == ["broken", "broken too"]


def test_fields_that_no_schema_names(spark, folder):
    zone = folder()
    land(zone, "1.json", doc("a"))
    land(zone, "2.json", doc("b", country={"code": "DE"}, tags=[1, "x"]), doc("c", country=None), "broken")
    rows = {r[0]: r for r in sources.landing_with_rest(spark, zone).select(
        "channelName", F.try_variant_get("rest", "$.country.code", "string"),
        F.try_variant_get("rest", "$.tags[1]", "string"), F.col("rest").isNull(), F.size("videos"),
    ).collect()}
    assert rows["a"][1:] == (None, None, True, 1)
    assert rows["b"][1:] == ("DE", "x", False, 1)
    assert rows["c"][1:] == (None, None, False, 1)
    kept = folder("kept")
    sources.landing_with_rest(spark, zone).write.parquet(kept)
    assert spark.read.parquet(kept).filter("variant_get(rest, '$.country.code', 'string') = 'DE'").count() == 1


# ---------------------------------------------------------------- versions


@pytest.fixture
def versions(spark, folder):
    path, schema = folder(), "key string, value int, part int"
    kinds = spark.createDataFrame([], schema).schema

    def add(version, *rows):
        sinks.land_version(spark.createDataFrame(list(rows), schema), path, "key", version, buckets=3)

    def current(**more):
        return sorted(tuple(r) for r in sinks.current_documents(spark, path, kinds, "key", **more).collect())

    return path, add, current, lambda: sinks.compact_versions(spark, path, kinds, "key")


def test_the_largest_version_of_a_key_counts(spark, versions):
    path, add, current, compact = versions
    add(0, *[(f"k{i}", i, 0) for i in range(20)])
    add(1, *[(f"k{i}", 100 + i, p) for i in range(0, 20, 4) for p in (0, 1)], (None, 5, 0))
    add(2, ("k1", 7, 0))
    expected = sorted(
        [(f"k{i}", 100 + i, p) for i in range(0, 20, 4) for p in (0, 1)] + [("k1", 7, 0), (None, 5, 0)]
        + [(f"k{i}", i, 0) for i in range(20) if i % 4 and i != 1], key=str
    )
    found = sorted(current(keys=["k1", "k4", "k2"]), key=str)
    assert found == [("k1", 7, 0), ("k2", 2, 0), ("k4", 104, 0), ("k4", 104, 1)]
    rows = lambda: sorted((tuple(r) for r in spark.read.parquet(path).select("key", "value", "part").collect()), key=str)
    assert len(rows()) == 32
    assert compact() == 6
    assert rows() == expected
    assert compact() == 0 and rows() == expected


def test_a_version_that_lands_again_replaces_itself(versions):
    _, add, current, compact = versions
    add(0, ("a", 1, 0), ("b", 1, 0))
    add(1, ("a", 2, 0))
    add(1, ("a", 3, 0))
    assert current() == [("a", 3, 0), ("b", 1, 0)]
    add(2, ("a", 4, 0), ("b", 4, 0))
    assert compact() == 3 and current() == [("a", 4, 0), ("b", 4, 0)]


# ---------------------------------------------------------------- states


def test_states_follow_the_batches(spark, folder, database):
    zone, checkpoint, table = folder(), folder("check"), f"{database}.curated"
    os.makedirs(zone)
    assert ingest_landing(spark, zone, table, checkpoint) == 0
    assert committed(spark, checkpoint) == -1
    rng = random.Random(1)
    for day in range(3):
        land(zone, "day.json", *[
            doc(rng.choice("abc"), [str(rng.randrange(100)) for _ in range(rng.randrange(4))], f"2024-0{1 + rng.randrange(3)}")
            for _ in range(6)
        ])
        ingest_landing(spark, zone, table, checkpoint, delete=True)
        last = committed(spark, checkpoint)
        assert last == day
        for _ in range(2):  # the second time nothing is new
            names = states.update_reports(spark, table, last, f"{database}.kept_")
        rows = spark.table(table)
        wanted = {
            "channel_subscribers": reports.channel_subscribers(rows), "video_count": reports.video_count(rows),
            "video_trend": reports.video_trend(rows),
            "most_viewed_videos": reports.most_viewed(rows, ordered=False),
        }
        for name, frame in wanted.items():
            found = spark.table(names[name])
            assert found.columns == frame.columns
            assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, frame.collect()), key=str)
    state = states.values_of("channelName", "viewCount")
    name = states.advance(spark, state, table, last, f"{database}.")
    found = states.choices(spark.table(name), "channelName", 2).collect()
    assert [tuple(r) for r in found] == [tuple(r) for r in spark.table(table).groupBy("channelName").count().orderBy("channelName").limit(2).collect()]


def test_an_update_reads_new_batches_only(spark, folder, database):
    zone, checkpoint, table = folder(), folder("check"), f"{database}.curated"
    for day in range(2):
        land(zone, "day.json", doc("a", ["1"]))
        ingest_landing(spark, zone, table, checkpoint, delete=True)
        states.advance(spark, states.titles(), table, day, f"{database}.")
    new = spark.table(f"{table}_batches").filter(F.col("batch").between(1, 1))
    assert "batch" in new._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert spark.table(f"{database}.state_titles").collect()[0]["through"] == 1


def test_a_batch_is_merged_in_one_shuffle(spark):
    columns = "channelName string, video_title string, viewCount int, subscribers int, year int, month int"
    first = [("a", "t", 1, 5, 2024, 1), ("a", None, 9, None, 2024, 1), (None, "t", None, 3, None, None)]
    second = [("a", "t", 4, 2, 2024, 1)] * 1_000 + [("a", None, 2, 7, 2024, 1), ("b", None, None, 1, 2024, 2)]
    wanted = {
        "months": [("a", 2024, 1, 1_001, 7), ("b", 2024, 2, 0, 1), (None, None, None, 1, 3)],
        "titles": [("a", "t", 4), ("a", None, 9), ("b", None, None), (None, "t", None)],
        "values": [
            ("channelName", "a", 1_003), ("channelName", "b", 1), ("channelName", None, 1),
            ("video_title", "t", 1_002), ("video_title", None, 3),
        ],
    }
    for state in (states.months(), states.titles(), states.values_of("channelName", "video_title")):
        frames = [spark.createDataFrame(rows, columns) for rows in (first, second)]
        known = state.merged(state.of(frames[0]))
        assert known._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        stored = spark.createDataFrame(known.collect(), known.schema)
        found = state.merged(stored, state.of(frames[1]))
        text = found._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 1 and text.index("Exchange") < text.index("partial_")
        assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted[state.name], key=str)


# ---------------------------------------------------------------- compaction


def test_many_small_files_become_few(spark, database):
    table = f"{database}.curated"
    sinks.create_curated(spark, table)
    at = F.when(F.col("id") > 2, F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 86_400 * 5))
    rows = spark.range(60).select(
        "id", F.lit("a").alias("c"), F.lit(1).alias("s"), F.lit(1).alias("n"),
        F.col("id").cast("string").alias("title"), at.alias("t"), F.col("id").cast("int").alias("v"),
    ).withColumns({"y": F.year("t"), "m": F.month("t")})
    for part in range(5):
        sinks.append_curated(rows.filter(F.col("id") % 5 == part).drop("id"), table)
    before = sorted(map(tuple, spark.table(table).collect()), key=str)
    n = spark.table(table).select(F.input_file_name()).distinct().count()
    months = spark.table(table).select("year", "month").distinct().count()
    assert n > 2 * months
    assert sinks.compact_table(spark, table) > 0
    assert sorted(map(tuple, spark.table(table).collect()), key=str) == before
    assert spark.table(table).select(F.input_file_name()).distinct().count() == months
    assert sinks.compact_table(spark, table) == 0
    sinks.append_curated(rows.drop("id"), table)
    assert spark.table(table).count() == 2 * len(before)


# ---------------------------------------------------------------- token chains

PAGES = "channel string, token string, next string, ids array<int>"


def chain(name, sizes):
    start, rows = 0, []
    for i, size in enumerate(sizes):
        rows.append((name, f"p{i}" if i else None, f"p{i + 1}" if i + 1 < len(sizes) else None, list(range(start, start + size))))
        start += size
    return rows


def test_chains_of_any_length(spark):
    rng = random.Random(2)
    rows = [x for name, n in [("a", 1), ("b", 2), ("c", 3), ("d", 64), ("e", 65), (None, 5)]
            for x in chain(name, [rng.randrange(4) for _ in range(n)])]
    rng.shuffle(rows)
    found = flatten_chain(spark.createDataFrame(rows, PAGES), "channel", "token", "next", "ids", "id").collect()
    assert len(found) == sum(len(r[3]) for r in rows)
    assert all(r["position"] == r["id"] for r in found)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    from reelstat.operators import chains

    original, steps = chains.written, []
    monkeypatch.setattr(chains, "written", lambda df, name: steps.append(name) or original(df, name))
    rows = chain("a", [1] * 10_000)
    random.Random(3).shuffle(rows)
    placed = chain_positions(spark.createDataFrame(rows, PAGES), "channel", "token", "next")
    assert all(r["page"] == r["ids"][0] for r in placed.collect())
    assert steps.count("steps") <= 16


@pytest.mark.parametrize("rows", [
    [("a", None, "x", [1]), ("a", "x", "y", [2]), ("a", "y", "x", [3])],
    [("a", "x", "y", [2]), ("a", "y", "x", [3])],
    [("a", None, "x", [1])],
    [("a", None, "x", [1]), ("a", "x", None, [1]), ("a", "x", None, [2])],
    [("a", None, None, [1]), ("a", "z", None, [2])],
])
def test_pages_that_are_no_chain(spark, rows):
    with pytest.raises(ValueError):
        chain_positions(spark.createDataFrame(rows, PAGES), "channel", "token", "next")


def test_no_pages(spark):
    assert flatten_chain(spark.createDataFrame([], PAGES), "channel", "token", "next", "ids").count() == 0


# ---------------------------------------------------------------- rules


def test_rules_by_group_and_role(spark):
    rows = spark.createDataFrame([(i, None if i == 7 else i % 3) for i in range(12)], "id int, kind int")
    rules = [
        Rule("kind = 0", frozenset({"x"}), group="g"), Rule("kind = 1", frozenset({"x", "y"}), group="g"),
        Rule("id > 2", frozenset({"x"})), Rule("id < 10", frozenset({"admin"}), base=True),
    ]
    ids = lambda *roles: sorted(r.id for r in visible(rows, rules, roles).collect())
    assert ids("x") == [3, 4, 6, 9]
    assert ids("y") == [1, 4]
    assert ids() == list(range(10))
    assert ids("admin") == list(range(12))
    assert ids("x", "admin") == [3, 4, 6, 9, 10]
    assert visible(rows, [], ["x"]).count() == 12
    assert visible(rows, [Rule("kind = 1", frozenset({"z"}))], ["x"]).count() == 12
