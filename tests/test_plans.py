"""What the physical plans must and must not contain."""

import re

import pytest
from oracle import plan
from pyspark.sql import Observation

from trendstrata.catalogue import QUERIES
from trendstrata.operators import metrics, quality, serving
from trendstrata.operators.categories import join_categories
from trendstrata.plans.silver import settle, silver_statistics, stage_measures, tallied_statistics
from trendstrata.plans.views import STAR_ORDER, event_statistics, nation_lookup, star_statistics
from trendstrata.sinks import write_table


@pytest.fixture(scope="module")
def silver(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver"))
    write_table(silver_statistics(star_statistics(spark, sf_dir), order=STAR_ORDER), path=path)
    return spark.read.parquet(path)


def read_columns(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^\n]*)>", text)]


def test_dedup_limits_each_task_before_the_shuffle(spark, sf_dir):
    text = plan(silver_statistics(event_statistics(spark, sf_dir), order=["seq"]))
    steps = [s.strip(" +-*:") for s in text.split("\n\n")[0].splitlines()]
    kinds = [re.sub(r" \(\d+\)|^\* ", "", s) for s in steps]
    assert kinds.count("WindowGroupLimit") == 2 and kinds.count("Exchange") == 1
    assert kinds.index("WindowGroupLimit") < kinds.index("Exchange") < len(kinds) - kinds[::-1].index("WindowGroupLimit")


def test_filters_reach_the_scan(spark, sf_dir, tmp_path):
    event_statistics(spark, sf_dir).write.parquet(str(tmp_path / "raw"))
    text = plan(silver_statistics(spark.read.parquet(str(tmp_path / "raw")), order=["seq"]))
    assert re.search(r"PushedFilters: \[[^\n]*IsNotNull\(video_id\)", text)


def test_summaries_read_only_their_columns(spark, silver, sf_dir):
    trending = plan(metrics.trending_analytics(silver))
    assert read_columns(trending) == [{
        "video_id", "channel_title", "category_id", "views", "likes", "dislikes", "comment_count",
        "trending_date_parsed", "like_ratio", "engagement_rate",
    }]
    assert "Join" not in trending
    channels = read_columns(plan(metrics.channel_analytics(silver, nation_lookup(spark, sf_dir))))
    # One wide scan; the names and the ranks read their own two columns.
    assert {"channel_title", "category_id"} in channels and {"channel_title", "views"} in channels
    assert sum(len(columns) > 2 for columns in channels) == 1
    checks = plan(quality.check_table(silver, "clean_statistics"))
    assert read_columns(checks) == [{"video_id", "title", "channel_title", "views", "_processed_at"}]


def test_channel_sums_stay_in_code_generation(silver):
    text = plan(metrics.channel_summary(silver))
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text
    # The distinct videos of a hot channel are spread before the channel is put together.
    assert text.count("Exchange") >= 2


def test_one_region_reads_one_partition(spark, silver, tmp_path):
    write_table(metrics.trending_analytics(silver), path=str(tmp_path))
    text = plan(serving.top_days(spark.read.parquet(str(tmp_path)), "am"))
    assert re.search(r"PartitionFilters: \[[^\n]*region#\d+ = am", text)
    assert "TakeOrderedAndProject" in text


def test_a_lookup_is_broadcast_only_when_small(spark, silver, sf_dir):
    lookup = nation_lookup(spark, sf_dir)
    assert "BroadcastHashJoin LeftOuter" in plan(join_categories(silver, lookup))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(join_categories(silver, lookup))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin LeftOuter" in text and "Broadcast" not in text


def test_names_are_joined_after_aggregating(silver, spark, sf_dir):
    text = plan(metrics.category_summary(silver, nation_lookup(spark, sf_dir))).split("\n\n")[0]
    assert text.index("BroadcastHashJoin") < text.index("HashAggregate")


def test_categories_read_the_statistics_once(spark, silver, sf_dir):
    columns = read_columns(plan(metrics.category_analytics(silver, nation_lookup(spark, sf_dir))))
    assert sum("views" in c for c in columns) == 1


def test_channel_names_join_where_they_are_aggregated(silver):
    """Both sides of the join are dealt by the same plain keys; nothing stands between aggregate and join."""
    before = silver.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    silver.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(metrics.channel_analytics(silver))
    finally:
        silver.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    tree = text.split("\n\n")[0]
    join = tree[tree.rindex("SortMergeJoin LeftOuter") :].splitlines()
    below = [re.sub(r"[^A-Za-z]", "", line) for line in join[1:4]]
    assert below[0] == "Sort" and "Aggregate" in below[1], join[:5]


def test_ranks_run_nothing_before_they_are_asked_for(spark, silver):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ranks", "planning only")
    try:
        ranked = metrics.rank_channels(metrics.channel_summary(silver))
        text = plan(ranked)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tracker.getJobIdsForGroup("ranks") == []
    # No window orders a whole region by views: each sees one bucket, or the bucket counts.
    windows = re.findall(r"\) Window\n.*?\n\n", text, re.S)
    assert len(windows) == 2 and all("_bucket" in w for w in windows)


def test_silver_is_written_without_another_sort_or_shuffle(spark, sf_dir, tmp_path):
    tallied = tallied_statistics(event_statistics(spark, sf_dir), order=["seq"])
    rows = settle(tallied.observe(Observation(), *stage_measures()))
    write_table(rows, "sorted_once", str(tmp_path / "t"), balance=False)
    rows.select(*spark.table("sorted_once").columns).createOrReplaceTempView("sorted_once_rows")
    try:
        text = spark.sql("EXPLAIN INSERT OVERWRITE TABLE sorted_once SELECT * FROM sorted_once_rows").first()[0]
    finally:
        spark.sql("DROP TABLE sorted_once")
        spark.catalog.dropTempView("sorted_once_rows")
    before_aggregate = text.split("SortAggregate")[0]
    assert "WriteFiles" in before_aggregate and "CollectMetrics" in before_aggregate
    assert "Sort [" not in before_aggregate and "Exchange" not in before_aggregate


@pytest.mark.parametrize("name", ["star_channel", "channel_analytics"])
def test_a_channel_query_makes_its_statistics_once(spark, sf_dir, name):
    """What the channel table reads several times are stored statistics, not the tables they are made from."""
    text = plan(QUERIES[name](spark, sf_dir))
    assert "lineitem.parquet" not in text and "events.parquet" not in text
    assert "/silver-" in text
