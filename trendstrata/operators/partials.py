"""Sums that can be kept and added up: one row per region, day, channel and category.

All gold tables are sums of these rows, but for the number of a channel's distinct
videos, which no sum gives.  When a day changes, only that day's rows are made anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstrata.functions import exact_sum, ratio_half_up
from trendstrata.operators.categories import name_categories
from trendstrata.operators.metrics import day_share, rank_channels, same_keys, with_stamp

DAY = ["region", "trending_date_parsed"]
GRAIN = [*DAY, "channel_title", "category_id"]
_EXACT = "decimal(38,4)"


def partial_statistics(stats: DataFrame) -> DataFrame:
    """Counts, exact sums and extremes per ``GRAIN``, and the latest stamp of the rows in them."""
    return stats.groupBy(*GRAIN).agg(
        F.count("video_id").alias("videos"),
        F.count("views").alias("n_views"),
        *[F.sum(c).alias(c) for c in ("views", "likes", "dislikes", "comment_count")],
        F.max("views").alias("max_views"),
        exact_sum(F.col("like_ratio")).cast(_EXACT).alias("like_sum"),
        F.count("like_ratio").alias("n_like"),
        exact_sum(F.col("engagement_rate")).cast(_EXACT).alias("engagement_sum"),
        F.count("engagement_rate").alias("n_engagement"),
        F.max("_processed_at").alias("_stamp"),
    )


def _total(name: str, alias: str) -> Column:
    return F.sum(name).alias(alias)


def _mean_views() -> Column:
    return ratio_half_up(F.sum("views").cast("decimal(20,0)"), F.sum("n_views"), 2).alias("avg_views_per_video")


def _mean(name: str) -> Column:
    return ratio_half_up(F.sum(f"{name}_sum"), F.sum(f"n_{name}"), 4)


def trending_from(partials: DataFrame, at: Column | None = None) -> DataFrame:
    """``trending_analytics`` of the rows that the partials stand for."""
    summary = partials.groupBy(*DAY).agg(
        _total("videos", "total_videos"),
        _total("views", "total_views"),
        _total("likes", "total_likes"),
        _total("dislikes", "total_dislikes"),
        _total("comment_count", "total_comments"),
        _mean_views(),
        _mean("like").alias("avg_like_ratio"),
        _mean("engagement").alias("avg_engagement_rate"),
        F.max("max_views").alias("max_views"),
        F.countDistinct("channel_title").alias("unique_channels"),
        F.countDistinct("category_id").alias("unique_categories"),
    )
    return with_stamp(summary, at)


def categories_from(partials: DataFrame, lookup: DataFrame | None = None, at: Column | None = None) -> DataFrame:
    """``category_analytics`` of the rows that the partials stand for."""
    summary = partials.groupBy("category_id", *DAY).agg(
        _total("videos", "video_count"),
        _total("views", "total_views"),
        _total("likes", "total_likes"),
        _total("comment_count", "total_comments"),
        _mean("engagement").alias("avg_engagement_rate"),
        F.countDistinct("channel_title").alias("unique_channels"),
    )
    named = name_categories(summary, lookup)
    keys = ["category_name", "category_id", *DAY]
    return with_stamp(day_share(named.select(*keys, *[c for c in summary.columns if c not in keys])), at)


def channels_from(
    partials: DataFrame, videos: DataFrame, lookup: DataFrame | None = None, at: Column | None = None
) -> DataFrame:
    """``channel_analytics`` of the rows that the partials stand for.

    ``videos`` are those rows themselves; only ``region, channel_title, video_id`` are read.
    """
    grain = ["channel_title", "region"]
    sums = partials.groupBy(*grain).agg(
        _total("views", "total_views"),
        _total("likes", "total_likes"),
        _total("comment_count", "total_comments"),
        _mean_views(),
        _mean("engagement").alias("avg_engagement_rate"),
        F.max("max_views").alias("peak_views"),
        # A silver row has a video, so videos are rows.
        F.coalesce(F.sum(F.when(F.col("trending_date_parsed").isNotNull(), F.col("videos"))), F.lit(0)).alias("times_trending"),
        F.min("trending_date_parsed").alias("first_trending"),
        F.max("trending_date_parsed").alias("last_trending"),
    )
    named = name_categories(partials.select(*grain, "category_id").distinct(), lookup)
    names = named.groupBy(*grain).agg(F.sort_array(F.collect_set("category_name")).alias("categories"))
    distinct = videos.groupBy(*grain).agg(F.countDistinct("video_id").alias("total_videos"))
    for other in (names, distinct):
        sums = same_keys(sums, other, grain)
    columns = [
        *grain, "total_videos", "total_views", "total_likes", "total_comments", "avg_views_per_video", "avg_engagement_rate",
        "peak_views", "times_trending", "first_trending", "last_trending", "categories",
    ]
    return with_stamp(rank_channels(sums.select(*columns)), at)
