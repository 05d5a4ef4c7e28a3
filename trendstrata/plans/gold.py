"""Silver tables to the gold summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstrata.operators.categories import category_lookup
from trendstrata.operators.metrics import category_analytics, channel_analytics, trending_analytics
from trendstrata.operators.partials import DAY, categories_from, channels_from, partial_statistics, trending_from

# The names of the gold tables.
GOLD_TABLES = ("trending_analytics", "channel_analytics", "category_analytics")


def gold_tables(
    stats: DataFrame, reference: DataFrame | None = None, at: Column | None = None
) -> dict[str, Callable[[], DataFrame]]:
    """How to build each gold table; without a reference all names are ``Unknown``.

    The tables share no cache: each reads its own few columns of the silver
    files, which is less than keeping the joined rows of all columns.
    """
    lookup = None if reference is None else category_lookup(reference)
    return {
        "trending_analytics": lambda: trending_analytics(stats, at),
        "channel_analytics": lambda: channel_analytics(stats, lookup, at),
        "category_analytics": lambda: category_analytics(stats, lookup, at),
    }


def changed_days(stats: DataFrame, held: DataFrame | None) -> DataFrame:
    """``region, trending_date_parsed, state`` of the days that the kept partials do not stand for: ``changed`` or ``gone``."""
    now = stats.groupBy(*DAY).agg(F.max("_processed_at").alias("_now"))
    if held is None:
        return now.select(*DAY, F.lit("changed").alias("state"))
    then = held.groupBy(*DAY).agg(F.max("_stamp").alias("_then"))
    then = then.select(F.col("region").alias("_region"), F.col("trending_date_parsed").alias("_day"), "_then")
    same = (F.col("region") == F.col("_region")) & F.col("trending_date_parsed").eqNullSafe(F.col("_day"))
    both = now.join(then, same, "full").filter(~F.col("_now").eqNullSafe(F.col("_then")))
    gone = F.col("region").isNull()
    return both.select(
        F.coalesce("region", "_region").alias("region"),
        F.when(gone, F.col("_day")).otherwise(F.col("trending_date_parsed")).alias("trending_date_parsed"),
        F.when(gone, F.lit("gone")).otherwise(F.lit("changed")).alias("state"),
    )


def merged_partials(stats: DataFrame, held: DataFrame | None, days: DataFrame) -> DataFrame:
    """The partials of the regions in ``days``: changed days from ``stats``, the others as they were kept."""
    which = days.select(F.col("region").alias("_region"), F.col("trending_date_parsed").alias("_day"), "state")
    same = (F.col("region") == F.col("_region")) & F.col("trending_date_parsed").eqNullSafe(F.col("_day"))
    anew = partial_statistics(stats.join(which.filter("state = 'changed'"), same, "left_semi"))
    if held is None:
        return anew
    regions = which.select("_region").distinct()
    kept = held.join(regions, F.col("region") == F.col("_region"), "left_semi").join(which, same, "left_anti")
    return anew.unionByName(kept)


def gold_from_partials(
    partials: DataFrame, stats: DataFrame, reference: DataFrame | None = None, at: Column | None = None
) -> dict[str, Callable[[], DataFrame]]:
    """As ``gold_tables``, from partials; ``stats`` only tells the channels' videos."""
    lookup = None if reference is None else category_lookup(reference)
    return {
        "trending_analytics": lambda: trending_from(partials, at),
        "channel_analytics": lambda: channels_from(partials, stats, lookup, at),
        "category_analytics": lambda: categories_from(partials, lookup, at),
    }
