"""Physical plans: what reaches the scan, how many shuffles, and what happens to hot keys."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelstat import schemas, sinks, sources, testbed
from reelstat.functions import published_since
from reelstat.operators import assemble_documents, having_keys, positions
from reelstat.operators.joins import match
from reelstat.plans import explore, reports
from reelstat.plans.curate import curate


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    from reelstat.session import fresh_database

    table = f"{fresh_database(spark)}.curated"
    sinks.create_curated(spark, table)
    sinks.append_curated(testbed.curated(spark, sf_dir), table)
    return spark.table(table)


def test_partition_filter(stored):
    text = plan(stored.filter("year = 1997 AND month = 3"))
    assert "PartitionFilters: [isnotnull(year" in text
    assert "(year" in text and "= 1997)" in text


def test_report_reads_two_columns_with_one_shuffle(stored):
    text = plan(reports.channel_subscribers(stored))
    assert "ReadSchema: struct<channelName:string,subscribers:int>" in text
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_max" in text


def test_channel_filter_is_pushed(stored):
    text = plan(sources.of_channels(stored, ["a", "b"]))
    assert "PushedFilters: [In(channelName, [a,b])]" in text


def test_rolling_window_is_pushed_for_both_timestamp_types(spark, sf_dir, stored):
    orders = testbed.table(spark, sf_dir, "orders")
    for frame, name in [(stored, "publishedAt"), (orders, "o_orderdate")]:
        text = plan(frame.filter(published_since(F.col(name), testbed.AS_OF)))
        assert f"GreaterThanOrEqual({name},2000-08-01" in text


def test_rolling_window_prunes_partitions(stored):
    text = plan(sources.curated_since(stored, testbed.AS_OF))
    assert "PartitionFilters: [((year" in text and "> 2000)" in text
    assert "GreaterThanOrEqual(publishedAt,2000-08-01" in text


def test_written_times_let_parquet_skip(spark, stored):
    path = stored.select(F.input_file_name()).limit(1).collect()[0][0].removeprefix("file://")
    import pyarrow.parquet as pq

    column = pq.ParquetFile(path).metadata.row_group(0).column(4)
    assert column.path_in_schema == "publishedAt" and column.is_stats_set


def test_without_hot_channels_children_are_shuffled_once(spark, sf_dir):
    text = final_plan(testbed.documents(spark, sf_dir)).split("Initial Plan")[0]
    assert text.count("/orders.parquet") == 2
    assert "LeftAnti" not in text and "Generate explode(sequence(0, FLOOR" not in text


def test_relative_filter_is_pushed(spark, sf_dir):
    from datetime import datetime

    events = testbed.table(spark, sf_dir, "events")
    text = plan(explore.relative_time_filter(events, "ts", datetime(2024, 1, 30, 12), 7))
    assert "GreaterThanOrEqual(ts,2024-01-23" in text and "LessThan(ts,2024-01-30" in text


def test_top_k_needs_no_full_sort(stored):
    text = plan(reports.top_videos(stored))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_top_k_per_channel_cuts_before_the_shuffle(stored):
    text = plan(reports.top_videos_per_channel(stored))
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_curate_reads_narrow_documents(spark, sf_dir):
    docs = sources.read_landing(
        spark, testbed.landing(spark, sf_dir), schemas.landing_for_curate()
    )
    text = plan(curate(docs))
    assert "description" not in text and "videoId" not in text
    assert "Exchange" not in text


def test_total_is_left_out_where_it_is_not_used(spark, sf_dir):
    assert plan(reports.video_count(testbed.curated(spark, sf_dir))).count("FileScan") == 2


def test_a_series_and_its_past_are_computed_once(stored):
    series = stored.groupBy("channelName", "year").agg(F.count("*").alias("n"))
    shifted = explore.time_shift(series, "year", "n", F.col("year") - 1, ["channelName"])
    text = final_plan(shifted).split("Initial Plan")[0]
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


def test_csv_keeps_to_the_columns_asked_for(spark, folder):
    path = folder()
    spark.sql("SELECT 1 AS a, 2 AS b").write.csv(path, header=True)
    assert "ReadSchema: struct<b:string>" in plan(sources.load_file(spark, path, "csv").select("b"))


# ---------------------------------------------------------------- hot keys


@pytest.fixture(scope="module")
def hot(spark, sf_dir):
    """Orders of which a third belong to customer 0, in several files."""
    from reelstat.session import fresh_dir

    path = fresh_dir(spark, "hot")
    orders = testbed.table(spark, sf_dir, "orders")
    owner = F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey"))
    orders.withColumn("o_custkey", owner.cast("bigint")).repartition(8).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def split_early(conf):
    """Sizes at which the small test data already counts as skewed and nothing is broadcast."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="5k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="5k",
        spark__sql__files__maxPartitionBytes="100k",
        spark__sql__files__openCostInBytes="100k",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )


def test_join_splits_a_hot_key(hot, split_early):
    totals = hot.groupBy("o_custkey").agg(F.count("*").alias("n"))
    joined = match(hot, totals, ["o_custkey"]).select("o_orderkey", "n")
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    assert joined.count() == hot.count()


def test_semi_join_splits_a_hot_key(hot, split_early):
    cells = hot.groupBy("o_custkey").count().filter("count > 15")
    detail = having_keys(hot, cells, ["o_custkey"])
    assert "SortMergeJoin(skew=true)" in final_plan(detail)
    want = hot.join(cells, "o_custkey", "left_semi")
    assert detail.count() == want.count() > hot.count() / 3


def test_curated_rows_split_a_hot_channel(spark, sf_dir, hot, split_early, monkeypatch):
    tables = {"orders": hot, "customer": testbed.table(spark, sf_dir, "customer")}
    monkeypatch.setattr(testbed, "table", lambda spark, sf_dir, name: tables[name])
    assert "SortMergeJoin(skew=true)" in final_plan(testbed.curated(spark, sf_dir))


def test_documents_split_a_hot_channel(spark, sf_dir, hot, split_early):
    parents = testbed.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    text = final_plan(documents_of(hot, parents, 100)).split("Initial Plan")[0]
    # Children meet by run of hashes, then by part; only grouped rows are windowed or joined by key.
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert any("_block1" in line for line in windows)
    assert any("collect_list" in line and "part" in line for line in text.splitlines())
    assert "SortMergeJoin(skew=false)" not in text and "LeftAnti" not in text


def test_documents_need_no_job_to_be_planned(spark, sf_dir, monkeypatch):
    monkeypatch.setattr("reelstat.session.written", None)
    calls = []
    monkeypatch.setattr("pyspark.sql.DataFrameWriter.parquet", lambda *_: calls.append(1))
    testbed.documents(spark, sf_dir)
    assert not calls


def test_reports_are_written_without_a_sort(spark, stored):
    from reelstat.plans import reports

    assert "rangepartitioning" not in plan(reports.most_viewed(stored, ordered=False))


def test_keys_are_broadcast_when_few(hot, conf):
    cells = hot.groupBy("o_custkey").count().filter("count > 15")
    assert "BroadcastHashJoin" in final_plan(having_keys(hot, cells, ["o_custkey"]))


def test_write_splits_a_hot_month(spark, database, hot, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="20k")
    table = f"{database}.t"
    sinks.create_curated(spark, table)
    one_month = hot.select(
        F.col("o_orderkey").cast("string"), F.lit(1), F.lit(1), F.uuid(),
        F.lit("2024-01-01").cast("timestamp"), F.lit(1),
        F.lit(2024).alias("year"), F.lit(1).alias("month"),
    )
    sinks.append_curated(one_month, table)
    files = spark.table(table).select(F.input_file_name()).distinct().count()
    assert files > 4
    assert spark.table(table).count() == hot.count()


def test_write_makes_one_file_per_small_month(spark, stored):
    files = stored.select(F.input_file_name()).distinct().count()
    months = stored.select("year", "month").distinct().count()
    assert files <= 2 * months


def documents_of(hot, parents, max_items):
    children = hot.select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").cast("string").alias("videoId")
    )
    return assemble_documents(parents, children, "c_custkey", max_items=max_items)


def test_hot_channel_is_split_into_documents(spark, sf_dir, hot):
    parents = testbed.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    docs = documents_of(hot, parents, 100).cache()
    sizes = docs.select("c_custkey", "part", "parts", F.size("videos").alias("n")).collect()
    n_hot = hot.filter("o_custkey = 0").count()
    of_hot = [r.n for r in sizes if r.c_custkey == 0]
    assert len(of_hot) == -(-n_hot // 100)
    assert sum(of_hot) == n_hot and max(of_hot) == 100
    assert sorted(r.part for r in sizes if r.c_custkey == 0) == list(range(len(of_hot)))
    assert {r.parts for r in sizes if r.c_custkey == 0} == {len(of_hot)}
    assert len({r.c_custkey for r in sizes}) == parents.count()
    exploded = docs.select("c_custkey", F.explode("videos.videoId").alias("id"))
    want = hot.select("o_custkey", F.col("o_orderkey").cast("string"))
    assert exploded.exceptAll(want).isEmpty() and want.exceptAll(exploded).isEmpty()
    docs.unpersist()


def test_copies_of_one_video_are_split_too(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k INT, name STRING")
    copies = spark.range(1005).select(F.lit(1).alias("k"), F.lit("same").alias("id"))
    children = copies.unionByName(spark.createDataFrame([(2, "x"), (2, "x"), (9, "orphan")], "k INT, id STRING"))
    docs = assemble_documents(parents, children, "k", max_items=100)
    rows = docs.select("name", F.size("videos").alias("n")).collect()
    assert sum(r.n for r in rows if r.name == "a") == 1005
    assert sorted(r.n for r in rows if r.name == "a") == [5] + [100] * 10
    assert [r.n for r in rows if r.name == "b"] == [2]
    assert [r.n for r in rows if r.name == "c"] == [0]


def test_children_of_small_keys_are_shuffled_once(spark, sf_dir):
    """No aggregation or sort of whole rows comes before that shuffle, and none deals them out after it."""
    docs = testbed.documents(spark, sf_dir)
    docs.collect()
    text = plan(docs).split("Initial Plan")[0]
    assert "Window [" not in text
    moved = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("REPARTITION_BY_NUM" in line for line in moved) == 1
    below = text[text.index("REPARTITION_BY_NUM"):].splitlines()[1:4]
    assert not any("Aggregate" in line or "Sort" in line for line in below)


def test_the_one_shuffle_moves_numbers_and_not_their_texts(spark, sf_dir):
    docs = testbed.documents(spark, sf_dir)
    docs.collect()
    text = plan(docs).split("Initial Plan")[0]
    below = text[text.index("REPARTITION_BY_NUM"):].splitlines()[1:6]
    columns = testbed.table(spark, sf_dir, "orders").columns
    made = [line for line in below if "Project [" in line]
    assert made and all(line.split("Project [")[1].count(",") < len(columns) for line in made)
    assert not any(word in line for line in below for word in ["struct(", "concat(", "date_format", "as string"])


def test_fields_made_after_the_shuffle_give_the_same_documents(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (4, "twice"), (None, "e")], "k INT, name STRING")
    raw = spark.range(6000).selectExpr("CASE WHEN id < 2500 THEN 1 WHEN id < 3500 THEN 2 WHEN id < 4600 THEN 4 WHEN id < 4610 THEN 9 END AS k",
                                       "id % 700 AS n", "CAST(id % 11 AS DOUBLE) AS price")
    fields = [F.col("n").cast("string").alias("id"), F.concat(F.lit("of "), "k").alias("owner"),
              F.lit(None).cast("string").alias("none"), F.col("price").cast("int").cast("string").alias("views")]
    for limit in (100, 1000, 10_000):  # all the long way; some; none
        late = assemble_documents(parents, raw, "k", max_items=limit, fields=fields)
        early = assemble_documents(parents, raw.select("k", *fields), "k", max_items=limit)
        assert late.schema.simpleString() == early.schema.simpleString()
        assert late.exceptAll(early).isEmpty() and early.exceptAll(late).isEmpty()


def test_hot_and_small_keys_give_the_documents_of_the_long_way(spark):
    from reelstat.operators import documents

    parents = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (4, "twice"), (None, "e")], "k INT, name STRING")
    rows = spark.range(6000).selectExpr("CASE WHEN id < 2500 THEN 1 WHEN id < 3500 THEN 2 WHEN id < 4600 THEN 4 WHEN id < 4610 THEN 9 END AS k",
                                        "CAST(id % 700 AS STRING) AS id")
    short = assemble_documents(parents, rows, "k", max_items=documents.LISTED_ITEMS)
    long = documents._in_parts(parents, rows.filter("k IS NOT NULL"), "k", "videos", documents.LISTED_ITEMS)
    assert short.schema.simpleString() == long.schema.simpleString()
    assert short.exceptAll(long).isEmpty() and long.exceptAll(short).isEmpty()
    sizes = Counter((r.name, r.part, r.parts, r.n) for r in short.select("*", F.size("videos").alias("n")).collect())
    assert sizes == Counter([
        ("a", 0, 3, 1000), ("a", 1, 3, 1000), ("a", 2, 3, 500), ("b", 0, 1, 1000), ("c", 0, 1, 0), ("e", 0, 1, 0),
        *[(name, part, 2, n) for name in ("d", "twice") for part, n in ((0, 1000), (1, 100))],
    ])


def test_positions_of_a_hot_key_use_many_tasks(spark):
    rows = spark.range(100_000).select(F.lit("hot").alias("key"), "id")
    numbered = positions(rows, ["key"], "id", block=1_000)
    assert numbered.filter(F.col("position") != F.col("id")).isEmpty()
    windows = [line for line in plan(numbered).splitlines() if "Window [" in line]
    assert all("_block" in line or "_head" in line for line in windows[:-1])


def test_documents_are_the_same_on_every_run(spark, sf_dir, hot):
    parents = testbed.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    first = documents_of(hot.repartition(3), parents, 50)
    second = documents_of(hot.repartition(7), parents, 50)
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()
