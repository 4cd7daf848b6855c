"""Edge fixtures of the landing, curated and reporting layers."""

import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reelstat import schemas, sinks, sources
from reelstat.functions import published_since, relative_range, safe_name, time_grain
from reelstat.operators import expand_nested, explode_videos, flatten_pages, positions, chunk_ids
from reelstat.plans import explore, reports
from reelstat.plans.curate import curate


@pytest.fixture
def land(spark, tmp_path):
    """Writes documents as JSON lines and reads them back with the landing schema."""

    def write(*docs, schema=None):
        path = tmp_path / f"{len(list(tmp_path.iterdir()))}.json"
        path.write_text("\n".join(json.dumps(doc) for doc in docs))
        return sources.read_landing(spark, str(path), schema)

    return write


def channel(name="Alpha", **more):
    return {"channelName": name, "subscribers": "10", "views": "99", "totalVideos": "2",
            "playlistId": "P1", "videos": [], **more}


def video(title="t1", views="9", at="2024-01-02T03:04:05Z", **more):
    return {"videoId": "v1", "channelTitle": "Alpha", "title": title, "description": "d",
            "publishedAt": at, "viewCount": views, "likeCount": None, "commentCount": "0",
            "duration": "PT1M", "definition": "hd", **more}


def test_curated_row(land):
    row = curate(land(channel(videos=[video()]))).collect()[0]
    assert row.asDict() == {
        "channelName": "Alpha", "subscribers": 10, "totalVideos": 2, "video_title": "t1",
        "publishedAt": datetime(2024, 1, 2, 3, 4, 5), "viewCount": 9, "year": 2024, "month": 1,
    }


def test_curated_schema_is_the_tables(land):
    for wide in [False, True]:
        frame = curate(land(channel(videos=[video()])), wide)
        assert [(f.name, f.dataType) for f in frame.schema] == [
            (f.name, f.dataType) for f in schemas.curated(wide)
        ]


def test_narrow_schema_gives_the_same_rows(land):
    docs = [channel(videos=[video(), video("t2", None)]), channel("Beta")]
    full, narrow = land(*docs), land(*docs, schema=schemas.landing_for_curate())
    assert curate(full).collect() == curate(narrow).collect()


def test_empty_missing_and_null_array_give_no_row(land):
    missing = channel("B")
    del missing["videos"]
    docs = land(channel("A"), missing, channel("C", videos=None), channel("D", videos=[video()]))
    assert [row.channelName for row in curate(docs).collect()] == ["D"]
    assert docs.count() == 4


def test_empty_array_alone_still_resolves(land):
    assert curate(land(channel())).count() == 0


def test_expanding_keeps_empty_channels(land):
    docs = land(channel("A"), channel("B", videos=[video()]))
    rows = expand_nested(docs).select("channelName", "videos_title").collect()
    assert sorted((r[0], r[1]) for r in rows) == [("A", None), ("B", "t1")]
    assert explode_videos(docs).count() == 1


def test_expanding_two_arrays_is_refused(spark):
    with pytest.raises(ValueError):
        expand_nested(spark.sql("SELECT array(1) AS a, array(2) AS b"))


def test_expanding_nested_structs_and_arrays(spark):
    frame = spark.sql("SELECT array(named_struct('x', named_struct('y', array(1, 2)))) AS a")
    assert [tuple(r) for r in expand_nested(frame).collect()] == [(1,), (2,)]
    assert expand_nested(frame).columns == ["a_x_y"]


@pytest.mark.parametrize(
    "text, number, wide",
    [("9", 9, 9), (None, None, None), ("abc", None, None), ("12.7", 12, 12), (".5", 0, 0), ("-3.9", -3, -3), ("1.2.3", None, None),
     ("3000000000", None, 3000000000), ("", None, None), ("-5", -5, -5)],
)
def test_count_casts(land, text, number, wide):
    docs = land(channel(videos=[video(views=text)]))
    assert curate(docs).collect()[0].viewCount == number
    assert curate(docs, wide=True).collect()[0].viewCount == wide


def test_missing_count_is_null(land):
    item = video()
    del item["viewCount"]
    assert curate(land(channel(videos=[item]))).collect()[0].viewCount is None


def test_maximum_ignores_null_and_all_null_sorts_last(land):
    rows = curate(land(channel(videos=[
        video("a", None), video("a", "3"), video("b", None), video("c", "5"),
    ])))
    got = [tuple(r) for r in reports.most_viewed(rows).collect()]
    assert got == [("Alpha", "c", 5), ("Alpha", "a", 3), ("Alpha", "b", None)]


@pytest.mark.parametrize("zone, year, month", [("UTC", 2023, 12), ("Asia/Singapore", 2024, 1)])
def test_year_and_month_follow_the_session_zone(land, conf, zone, year, month):
    conf(spark__sql__session__timeZone=zone)
    row = curate(land(channel(videos=[video(at="2023-12-31T23:30:00Z")]))).collect()[0]
    assert (row.year, row.month) == (year, month)


def test_malformed_time_forms_one_null_group(land):
    rows = curate(land(channel(videos=[video(at="soon"), video(at="later"), video()])))
    trend = {(r.year, r.month): r.monthlyVideosPublished for r in reports.video_trend(rows).collect()}
    assert trend == {(None, None): 2, (2024, 1): 1}


def test_ingesting_twice_doubles_counts_and_keeps_maxima(spark, land, database):
    table = f"{database}.curated"
    rows = curate(land(channel(videos=[video(), video("t2", "4")])))
    sinks.create_curated(spark, table)
    for _ in range(2):
        sinks.append_curated(rows, table)
    stored = spark.table(table)
    assert reports.video_count(stored).collect()[0].totalVideosPublished == 4
    assert reports.channel_subscribers(stored).collect()[0].totalSubscribers == 10
    assert {r.totalViews for r in reports.most_viewed(stored).collect()} == {9, 4}


def test_same_title_is_one_row(land):
    rows = curate(land(channel(videos=[video(views="1"), video(views="7")])))
    assert [tuple(r) for r in reports.most_viewed(rows).collect()] == [("Alpha", "t1", 7)]


def test_top_compares_numbers(land):
    rows = curate(land(channel(videos=[video("a", "9"), video("b", "10")])))
    assert [r.viewCount for r in reports.top_videos(rows, 1).collect()] == [10]
    assert [r.viewCount for r in reports.top_videos_per_channel(rows, 1).collect()] == [10]


def test_tie_at_the_border_is_settled(land):
    items = [video(t, "5", at) for t, at in [
        ("b", "2024-01-02T00:00:00Z"), ("b", "2024-01-01T00:00:00Z"), ("a", "2024-01-03T00:00:00Z"),
    ]]
    rows = curate(land(channel(videos=items)))
    top = reports.top_videos_per_channel(rows, 2).orderBy("rank").collect()
    assert [(r.video_title, r.publishedAt.day) for r in top] == [("a", 3), ("b", 1)]


def test_top_keeps_equal_rows(land):
    rows = curate(land(channel(videos=[video()] * 4)))
    assert reports.top_videos_per_channel(rows, 3).count() == 3


def test_top_beyond_the_threshold(land, conf):
    rows = curate(land(channel(videos=[video(str(i)) for i in range(40)])))
    want = reports.top_videos_per_channel(rows, 30).collect()
    conf(spark__sql__optimizer__windowGroupLimitThreshold="2")
    assert sorted(reports.top_videos_per_channel(rows, 30).collect()) == sorted(want)
    assert len(want) == 30


def test_null_title_is_not_counted(land):
    rows = curate(land(channel(videos=[video(None), video("a")])))
    assert reports.video_count(rows).collect()[0].totalVideosPublished == 1


def test_safe_name(spark):
    frame = spark.sql("SELECT 'The Daily  News' AS n").select(safe_name(F.col("n")))
    assert frame.collect()[0][0] == "The_Daily__News"


@pytest.mark.parametrize("n, chunks", [(0, []), (1, [1]), (50, [50]), (51, [50, 1]), (101, [50, 50, 1])])
def test_chunks_of_fifty(spark, n, chunks):
    listed = spark.range(n).select(F.lit("a").alias("key"), F.col("id").alias("position"), "id")
    rows = chunk_ids(listed, "key", "id").orderBy("chunk").collect()
    assert [len(r.ids.split(",")) for r in rows] == chunks
    assert ",".join(r.ids for r in rows) == ",".join(map(str, range(n)))


def test_pages_of_unequal_length_keep_their_order(spark):
    pages = spark.createDataFrame(
        [("a", 7, ["x", "y"]), ("a", 2, ["p"]), ("a", 5, []), ("a", 6, None), ("b", 1, ["q", "q"]),
         (None, 1, ["n"])],
        "key STRING, page INT, ids ARRAY<STRING>",
    )
    got = {(r.key, r.position): r.videoId for r in flatten_pages(pages, "key", "page", "ids").collect()}
    assert got == {("a", 0): "p", ("a", 1): "x", ("a", 2): "y", ("b", 0): "q", ("b", 1): "q",
                   (None, 0): "n"}


@pytest.mark.parametrize("block", [1, 3, 7, 1 << 20])
def test_positions_do_not_depend_on_the_block(spark, block):
    rows = spark.range(200).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("key"),
        (F.col("id") * 37 % 211 - 100).alias("at"),
    )
    got = [tuple(r) for r in positions(rows, ["key"], "at", block=block).collect()]
    by_key = {}
    for key, at, position in got:
        by_key.setdefault(key, []).append((at, position))
    assert len(got) == 200
    for members in by_key.values():
        assert [p for _, p in sorted(members)] == list(range(len(members)))


def test_border_of_the_rolling_window_is_kept(spark):
    as_of = datetime(2024, 6, 30, 12)
    frame = spark.createDataFrame(
        [("2023-07-01T12:00:00Z",), ("2023-07-01T11:59:59Z",)], "at STRING"
    ).withColumn("ts", F.col("at").cast("timestamp"))
    for keep in [published_since(F.col("at"), as_of, iso=True), published_since(F.col("ts"), as_of)]:
        assert [r.at for r in frame.filter(keep).collect()] == ["2023-07-01T12:00:00Z"]


def test_instants_do_not_depend_on_the_machine(spark, conf):
    conf(spark__sql__session__timeZone="Asia/Singapore")
    frame = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS ts, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS plain")
    for name in ["ts", "plain"]:
        assert frame.filter(published_since(F.col(name), datetime(2024, 1, 1), days=0)).count() == 1
        late = published_since(F.col(name), datetime(2024, 1, 1, 0, 0, 1), days=0)
        assert frame.filter(late).count() == 0


@pytest.mark.parametrize("start, end, hours", [
    ("today", "today", [0, 23]), ("today", "now", [0, 23, 24, 35]), ("now", "now", [23, 24, 35]),
])
def test_relative_anchors(spark, start, end, hours):
    frame = spark.createDataFrame([(h,) for h in [-1, 0, 23, 24, 35, 36]], "h INT").select(
        "h", (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours="h")).alias("ts")
    )
    keep = relative_range(F.col("ts"), datetime(2024, 1, 2, 12), 1, start, end)
    assert [r.h for r in frame.filter(keep).collect()] == hours


def test_unknown_anchor(spark):
    with pytest.raises(ValueError):
        relative_range(F.col("ts"), datetime(2024, 1, 1), 1, "noon")


def test_grains(spark):
    frame = spark.sql("SELECT TIMESTAMP '2024-05-17 13:45:07' AS ts")
    got = [frame.select(time_grain(F.col("ts"), g)).collect()[0][0] for g in ["month", "hour", "2 seconds"]]
    assert got == [datetime(2024, 5, 1), datetime(2024, 5, 17, 13), datetime(2024, 5, 17, 13, 45, 6)]


def test_shift_over_a_gap(spark):
    series = spark.createDataFrame([(2020, 1), (2021, 2), (2023, 3)], "year INT, n INT")
    rows = explore.time_shift(series, "year", "n", F.col("year") - 1).orderBy("year").collect()
    assert [r.prev for r in rows] == [None, 1, None]


def test_shift_within_keys_with_null(spark):
    series = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 2, 7)], "k STRING, t INT, n INT")
    rows = explore.time_shift(series, "t", "n", F.col("t") - 1, ["k"]).collect()
    assert {(r.k, r.t): r.prev for r in rows} == {(None, 1): None, (None, 2): 5, ("a", 2): None}


def test_limits(spark):
    rows = spark.range(200_000)
    assert explore.limited(rows, explore.CHART_ROWS).count() == 50_000
    assert explore.limited(rows, 10).count() == 10
    for n in (100_001, -1):
        with pytest.raises(ValueError, match="rows asked for"):
            explore.limited(rows, n)
    assert explore.sample_rows(rows).count() == 1_000


def test_filter_values(spark):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    assert explore.filter_values(rows, "k", explore.FILTER_ROWS).count() == 1_000
    assert [r.k for r in explore.filter_values(rows, "k", 10, search="19999").collect()] == ["19999"]
    with pytest.raises(ValueError, match="rows asked for"):
        explore.filter_values(rows, "k", 20_000)


def test_stored_limits(spark, database):
    table = f"{database}.first_rows"
    explore.ctas_limited(spark.range(5_000), table, 2_000)
    assert spark.table(table).count() == 2_000
    with pytest.raises(ValueError, match="rows asked for"):
        explore.ctas_limited(spark.range(5), table, 200_000)


@pytest.mark.parametrize("grain", ["hourz", "", "0 days", "x days", "1.5 hours", "millennium"])
def test_unknown_grains(grain):
    with pytest.raises(ValueError, match="unknown grain"):
        time_grain(F.col("ts"), grain)


def test_grains_keep_rows_without_a_time(spark):
    frame = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-05-17 13:45:07'), (NULL) AS t(ts)")
    for grain, start in [
        ("hour", datetime(2024, 5, 17, 13)), ("15 minutes", datetime(2024, 5, 17, 13, 45)),
        ("3 months", datetime(2024, 4, 1)), ("2 quarters", datetime(2024, 1, 1)),
        ("5 years", datetime(2020, 1, 1)), ("2 days", datetime(2024, 5, 17)),
    ]:
        got = {r[0] for r in frame.select(time_grain(F.col("ts"), grain)).collect()}
        assert got == {start, None}, grain


@pytest.mark.parametrize("zone", ["UTC", "Asia/Singapore", "America/New_York"])
@pytest.mark.parametrize("aware", [False, True])
def test_text_and_time_agree_in_every_zone(spark, conf, zone, aware):
    conf(spark__sql__session__timeZone=zone)
    as_of = datetime(2024, 1, 1, tzinfo=timezone.utc if aware else None)
    frame = spark.sql(
        "SELECT explode(sequence(0, 72)) AS h"
    ).selectExpr("date_format(timestampadd(HOUR, h, TIMESTAMP_NTZ'2022-12-31 00:00:00'), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS t")
    rows = frame.select(
        published_since(F.col("t"), as_of, iso=True).alias("a"),
        published_since(F.col("t").cast("timestamp"), as_of).alias("b"),
    ).collect()
    assert [r.a for r in rows] == [r.b for r in rows]
    assert 0 < sum(r.a for r in rows) < len(rows)


def test_rules(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k STRING, n INT")
    rules = spark.createDataFrame([("r", "a"), ("r", "a"), ("s", "b")], "role STRING, k STRING")
    seen = lambda role: sorted(r.n for r in explore.row_level_filter(rows, rules, role, {"k": "k"}).collect())
    assert seen("r") == [1]
    assert seen("s") == [2]
    assert seen("unknown") == []


def test_drilling_into_a_null_cell(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2)], "k STRING, n INT")
    cells = rows.groupBy("k").count().filter("k IS NULL")
    assert [r.n for r in explore.drill_to_detail(rows, cells, ["k"]).collect()] == [2]


def test_parameters_are_values_not_text(spark):
    rows = spark.createDataFrame([("x' OR '1'='1",), ("y",)], "k STRING")
    got = explore.parameterised_sql(
        spark, "SELECT k FROM {t} WHERE k = :k", {"k": "x' OR '1'='1"}, t=rows
    )
    assert got.count() == 1


# ---------------------------------------------------------------- responses


def test_channel_response(spark):
    text = json.dumps({"items": [{
        "snippet": {"title": "Alpha"},
        "statistics": {"subscriberCount": "10", "viewCount": "99", "videoCount": "2"},
        "contentDetails": {"relatedPlaylists": {"uploads": "P1"}},
    }]})
    frame = spark.createDataFrame([("id1", text), ("id2", "{}")], "id STRING, response STRING")
    rows = [tuple(r) for r in sources.channels_from_responses(frame).orderBy("id").collect()]
    assert rows == [("id1", "Alpha", "10", "99", "2", "P1"), ("id2", None, None, None, None, None)]


def test_playlist_pages(spark):
    pages = [
        {"items": [{"contentDetails": {"videoId": v}} for v in "ab"], "nextPageToken": "T"},
        {"items": [{"contentDetails": {"videoId": "c"}}]},
    ]
    frame = spark.createDataFrame(
        [("P1", i, json.dumps(p)) for i, p in enumerate(pages)], "playlistId STRING, page INT, response STRING"
    )
    parsed = sources.ids_from_playlist_pages(frame)
    assert [(r.videoIds, r.hasNext) for r in parsed.orderBy("page").collect()] == [
        (["a", "b"], True), (["c"], False)
    ]
    flat = flatten_pages(parsed, "playlistId", "page", "videoIds").orderBy("position")
    assert [r.videoId for r in flat.collect()] == ["a", "b", "c"]


def test_video_responses(spark):
    def item(name, at, stats, details):
        return {"id": name, "snippet": {"channelTitle": "A", "title": name, "description": "", "publishedAt": at},
                "statistics": stats, "contentDetails": details}

    text = json.dumps({"items": [
        item("v1", "2024-01-01T00:00:00Z", {"viewCount": "5"}, {"definition": "hd"}),
        item("v2", "2023-01-01T00:00:00Z", {}, {"duration": "PT2M", "definition": "sd"}),
        item("old", "2022-12-31T23:59:59Z", {}, {"definition": "sd"}),
    ]})
    frame = spark.createDataFrame([("Alpha", text)], "channelName STRING, response STRING")
    rows = sources.videos_from_responses(frame, datetime(2024, 1, 1)).collect()
    assert rows[0].__fields__ == ["channelName", *schemas.VIDEO_FIELDS]
    assert [(r.videoId, r.viewCount, r.likeCount, r.duration) for r in rows] == [
        ("v1", "5", None, "0"), ("v2", None, None, "PT2M")
    ]
    assert sources.videos_from_responses(frame).count() == 3


# ---------------------------------------------------------------- files


def test_headerless_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,x\n2,y\n")
    frame = sources.read_csv_headerless(spark, str(tmp_path))
    assert frame.dtypes == [("_c0", "string"), ("_c1", "string")]
    assert frame.count() == 2


@pytest.mark.parametrize("kind, sep", [("csv", ","), ("tsv", "\t"), ("txt", ",")])
def test_uploads_read_missing_values_as_null(spark, tmp_path, kind, sep):
    lines = [["n", "my name"], ["1", "N/A"], ["nan", "b"], ["", "null"]]
    (tmp_path / f"a.{kind}").write_text("\n".join(sep.join(line) for line in lines) + "\n")
    plain = sources.load_file(spark, str(tmp_path), kind)
    assert [tuple(r) for r in plain.collect()] == [("1", None), (None, "b"), (None, None)]
    typed = sources.load_file(spark, str(tmp_path), kind, "n INT, name STRING")
    assert [tuple(r) for r in typed.collect()] == [(1, None), (None, "b"), (None, None)]


def test_upload_of_parquet(spark, folder):
    path = folder()
    spark.range(3).write.parquet(path)
    assert sources.load_file(spark, path, "parquet").count() == 3


def test_unknown_kind_of_upload(spark):
    with pytest.raises(ValueError):
        sources.load_file(spark, "x", "xlsx")


def test_csv_export_round_trip(spark, folder):
    path = folder()
    rows = spark.createDataFrame([("é, \"q\"\nline", 1), (None, 2), ("", 3), ("  x ", 4)], "s STRING, n INT")
    sinks.write_csv(rows, path)
    back = sources.load_file(spark, path, "csv", "s STRING, n INT", na=[], multiline=True)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    text = "".join(p.read_text() for p in Path(path.removeprefix("file:")).glob("part-*"))
    assert '"é, ""q""' in text and '"",3' in text


def test_uploads_follow_standard_quoting(spark, tmp_path):
    (tmp_path / "a.csv").write_text('s,n\n"say ""hi"", ok",1\n"two\nlines",2\n')
    rows = sources.load_file(spark, str(tmp_path), "csv", "s STRING, n INT", multiline=True).collect()
    assert [tuple(r) for r in rows] == [('say "hi", ok', 1), ("two\nlines", 2)]


def test_uploads_that_do_not_fit_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n3,4,5\n")
    for schema in ("a INT", "a INT, b INT, c INT"):
        with pytest.raises(ValueError, match="columns"):
            sources.load_file(spark, str(tmp_path), "csv", schema)
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.load_file(spark, str(tmp_path), "csv").collect()


def test_names_that_would_clash_are_refused(spark):
    frame = spark.sql("SELECT named_struct('b', 1) AS a, 2 AS a_b")
    with pytest.raises(ValueError, match="a_b"):
        expand_nested(frame)
