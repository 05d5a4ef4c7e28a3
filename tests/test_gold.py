"""Gold summaries, ranks, names and serving queries."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from trendstrata.operators.categories import category_lookup, name_categories
from trendstrata.operators.metrics import category_analytics, channel_analytics, rank_channels, trending_analytics
from trendstrata.operators.ranking import rank_within
from trendstrata.operators.serving import category_counts, top_channels, top_days
from trendstrata.plans.silver import silver_statistics
from trendstrata.plans.views import STAR_ORDER, event_statistics, nation_lookup, star_statistics

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)
SCHEMA = (
    "video_id string, region string, trending_date_parsed date, channel_title string, category_id long, "
    "views long, likes long, dislikes long, comment_count long, like_ratio double, engagement_rate double"
)


@pytest.fixture
def stats(spark):
    return spark.createDataFrame(
        [
            ("v1", "us", D1, "a", 1, 100, 10, 1, 2, 10.0, 13.0),
            ("v1", "us", D2, "a", 1, 200, 10, 1, 2, 5.0, 6.5),
            ("v2", "us", D1, "a", 2, 300, 0, 0, 0, 0.0, 0.0),
            ("v3", "us", D1, "b", None, 600, 6, 0, 0, 1.0, 1.0),
            ("v4", "us", None, None, 9, 0, 0, 0, 0, 0.0, 0.0),
        ],
        SCHEMA,
    )


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame([(1, "Music"), (2, "Music"), (3, "News")], "category_id long, category_name string")


def test_trending(stats, rows):
    assert rows(trending_analytics(stats).drop("_aggregated_at")) == [
        ("us", None, 1, 0, 0, 0, 0, 0.0, 0.0, 0.0, 0, 0, 1),
        ("us", D1, 3, 1000, 16, 1, 2, 333.33, 3.6667, 4.6667, 600, 2, 2),
        ("us", D2, 1, 200, 10, 1, 2, 200.0, 5.0, 6.5, 200, 1, 1),
    ]


def test_channel(stats, lookup, rows):
    got = channel_analytics(stats, lookup)
    assert got.columns == [
        "channel_title", "region", "total_videos", "total_views", "total_likes", "total_comments",
        "avg_views_per_video", "avg_engagement_rate", "peak_views", "times_trending", "first_trending",
        "last_trending", "categories", "rank_in_region", "_aggregated_at",
    ]
    assert rows(got.drop("_aggregated_at")) == [
        (None, "us", 1, 0, 0, 0, 0.0, 0.0, 0, 0, None, None, ["Unknown"], 3),
        ("a", "us", 2, 600, 20, 4, 200.0, 6.5, 300, 3, D1, D2, ["Music"], 1),
        ("b", "us", 1, 600, 6, 0, 600.0, 1.0, 600, 1, D1, D1, ["Unknown"], 2),
    ]


def test_category(stats, lookup, rows):
    assert rows(category_analytics(stats, lookup).drop("_aggregated_at")) == [
        ("Music", 1, "us", D1, 1, 100, 10, 2, 13.0, 1, 10.0),
        ("Music", 1, "us", D2, 1, 200, 10, 2, 6.5, 1, 100.0),
        ("Music", 2, "us", D1, 1, 300, 0, 0, 0.0, 1, 30.0),
        ("Unknown", None, "us", D1, 1, 600, 6, 0, 1.0, 1, 60.0),
        ("Unknown", 9, "us", None, 1, 0, 0, 0, 0.0, 0, None),
    ]


def test_names(spark, stats, lookup, rows):
    assert rows(name_categories(stats, lookup), "video_id", "category_name") == [
        ("v1", "Music"), ("v1", "Music"), ("v2", "Music"), ("v3", "Unknown"), ("v4", "Unknown"),
    ]
    assert {r[0] for r in rows(name_categories(stats, None), "category_name")} == {"Unknown"}
    untitled = spark.createDataFrame([(1, None)], "category_id long, category_name string")
    assert {r[0] for r in rows(name_categories(stats, untitled), "category_name")} == {"Unknown"}


def test_lookup_column_forms(spark, rows):
    data = [("1", "B"), ("1", "A"), ("x", "C"), (None, "D"), ("2.0", None)]
    for title in ("snippet_title", "snippet.title"):
        reference = spark.createDataFrame(data, "id string, title string").withColumnRenamed("title", title)
        assert rows(category_lookup(reference)) == [(1, "A"), (2, None)]
    assert category_lookup(spark.createDataFrame(data, "id string, name string")) is None


def test_sums_do_not_depend_on_row_order(spark, sf_dir):
    silver = silver_statistics(event_statistics(spark, sf_dir), order=["seq"]).persist()
    first = trending_analytics(silver).drop("_aggregated_at")
    again = trending_analytics(silver.repartition(13, F.rand(3))).drop("_aggregated_at")
    assert first.exceptAll(again).isEmpty()
    silver.unpersist()


def test_invariants(spark, sf_dir):
    silver = silver_statistics(star_statistics(spark, sf_dir), order=STAR_ORDER)
    category = category_analytics(silver, nation_lookup(spark, sf_dir))
    day = category.groupBy("region", "trending_date_parsed").agg(
        F.sum("view_share_pct").alias("share"), F.count(F.lit(1)).alias("n")
    )
    assert day.filter(F.abs(F.col("share") - 100) > F.col("n") * 0.005 + 1e-9).isEmpty()
    ranks = channel_analytics(silver).groupBy("region").agg(
        F.min("rank_in_region").alias("lo"), F.max("rank_in_region").alias("hi"),
        F.countDistinct("rank_in_region").alias("d"), F.count(F.lit(1)).alias("n"),
    )
    assert ranks.filter("lo <> 1 OR hi <> n OR d <> n").isEmpty()


def test_rank_of_one_large_group_over_many_tasks(spark):
    """One group holds nearly everything and most values tie; a window is the yardstick."""
    df = spark.range(0, 20_000, numPartitions=7).select(
        F.when(F.col("id") % 100 == 0, F.lit(None)).when(F.col("id") % 3 == 0, "x").otherwise("big").alias("region"),
        F.concat(F.lit("c"), F.col("id")).alias("channel_title"),
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 50).alias("total_views"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = rank_channels(df).persist()
        assert ranked.select(F.spark_partition_id()).distinct().count() > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    by = Window.partitionBy("region").orderBy(F.desc("total_views"), "channel_title")
    expected = df.withColumn("rank_in_region", F.row_number().over(by))
    assert ranked.count() == 20_000 and ranked.exceptAll(expected).isEmpty()
    ranked.unpersist()


def test_rank_with_and_without_rows(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    ranked = rank_within(df, ["g"], [("v", False)], "r")
    assert ranked.filter(F.col("r") != F.floor((F.lit(99) - F.col("v")) / 3) + 1).isEmpty()
    assert rank_within(df.limit(0), ["g"], [("v", False)], "r").count() == 0


def test_serving(spark, stats, lookup, rows):
    trending = trending_analytics(stats)
    assert [r["trending_date_parsed"] for r in top_days(trending, "us", 2).collect()] == [D1, D2]
    assert top_days(trending, "gb").count() == 0
    assert [tuple(r) for r in top_channels(channel_analytics(stats, lookup), 2).collect()] == [("a", 600), ("b", 600)]
    counts = category_counts(category_analytics(stats, lookup)).collect()
    assert [tuple(r) for r in counts] == [("Music", "us", 3), ("Unknown", "us", 2)]
