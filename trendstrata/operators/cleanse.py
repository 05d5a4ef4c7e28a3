"""From raw text columns to typed, cleansed statistics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstrata.functions import parse_trending_date, per_hundred, to_boolean, to_long
from trendstrata.schemas import BOOLEAN_COLUMNS, COUNTERS, LONG_COLUMNS, RAW_COLUMNS


def _typed(name: str) -> Column:
    if name in LONG_COLUMNS:
        return to_long(F.col(name)).alias(name)
    if name in BOOLEAN_COLUMNS:
        return to_boolean(F.col(name)).alias(name)
    return F.col(name).cast("string").alias(name)


def enforce_schema(df: DataFrame, carry: Iterable[str] = ()) -> DataFrame:
    """The raw columns and region in their target types; bad values are NULL.

    ``carry`` names further columns to pass through, such as a record order.
    """
    return df.select(*[_typed(name) for name in (*RAW_COLUMNS, "region")], *carry)


def normalise_region(df: DataFrame) -> DataFrame:
    return df.withColumn("region", F.lower(F.trim("region")))


def is_valid() -> Column:
    """A usable row has a video and a region; never NULL itself."""
    return F.col("video_id").isNotNull() & F.coalesce(F.col("region") != "", F.lit(False))


def drop_invalid(df: DataFrame) -> DataFrame:
    return df.filter(is_valid())


def parse_dates(df: DataFrame) -> DataFrame:
    return df.withColumn("trending_date_parsed", parse_trending_date(F.col("trending_date")))


def zero_fill(df: DataFrame, columns: Iterable[str] = COUNTERS) -> DataFrame:
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(0).cast("long")) for name in columns})


def add_ratios(df: DataFrame) -> DataFrame:
    """``like_ratio`` and ``engagement_rate`` per hundred views.

    The reactions are added as doubles: a nonsense counter then gives a
    nonsense ratio instead of an overflow error for the whole job.
    """
    views, likes, dislikes, comments = (F.col(name).cast("double") for name in COUNTERS)
    return df.withColumns(
        {
            "like_ratio": per_hundred(likes, views),
            "engagement_rate": per_hundred(likes + dislikes + comments, views),
        }
    )


def stamp(df: DataFrame, job_name: str, processed_at: Column | None = None) -> DataFrame:
    """When and by which job the row was made."""
    when = F.current_timestamp() if processed_at is None else processed_at
    return df.withColumns({"_processed_at": when, "_job_name": F.lit(job_name)})
