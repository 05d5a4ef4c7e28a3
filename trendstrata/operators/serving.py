"""Ad-hoc questions to the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_days(trending: DataFrame, region: str, n: int = 10) -> DataFrame:
    """A region's days with the highest mean views; prunes to one partition."""
    return (
        trending.filter(F.col("region") == region)
        .orderBy(F.desc("avg_views_per_video"), F.asc("trending_date_parsed"))
        .limit(n)
    )


def top_channels(channels: DataFrame, n: int = 20) -> DataFrame:
    """Channels with the most views over all regions."""
    return (
        channels.groupBy("channel_title")
        .agg(F.sum("total_views").alias("total_views"))
        .orderBy(F.desc("total_views"), F.asc("channel_title"))
        .limit(n)
    )


def category_counts(categories: DataFrame) -> DataFrame:
    """On how many days each category trended in each region."""
    return (
        categories.groupBy("category_name", "region")
        .agg(F.count(F.lit(1)).alias("trending_count"))
        .orderBy(F.desc("trending_count"), "category_name", "region")
    )
