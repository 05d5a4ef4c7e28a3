"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` columns for each key.

    ``order`` should single out one row, so that a rerun picks the same one.
    Spark limits each task to one row per key before the shuffle, so a key with
    a third of all rows costs no more than any other.
    """
    by = [F.desc_nulls_last(c) for c in order if c not in keys]
    newest = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth")


def dedup_tallied(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tallies: Mapping[str, Column]
) -> DataFrame:
    """As ``dedup_latest``, with aggregates over all rows of each key beside the kept one.

    The tallies travel with the data.  Counters kept outside it would count
    again each time a lost task before the shuffle is rerun.  The greatest
    struct is the kept row itself, so each row is shuffled at most once and
    without a second copy of its order columns.
    """
    first = [c for c in order if c not in keys]
    row = [*first, *[c for c in df.columns if c not in keys and c not in first]]
    kept = df.groupBy(*keys).agg(
        F.max(F.struct(*row)).alias("_kept"),
        *[tally.alias(name) for name, tally in tallies.items()],
    )
    return kept.select(*[F.col(c) if c in keys else F.col(f"_kept.{c}") for c in df.columns], *tallies)


def dedup_last(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """The last occurrence of each key by position."""
    return dedup_latest(df, keys, [position])


def latest_file_per_region(
    df: DataFrame,
    order: Sequence[str] = ("_source_file",),
    region: str = "region",
) -> DataFrame:
    """Only the rows (or documents) of each region's greatest file.

    The winner is found by an aggregate, which shuffles one row per region and
    task; a window over the region would pull a whole region into one task.
    """
    winner = df.groupBy(F.col(region).alias("_of")).agg(F.max(F.struct(*order)).alias("_latest"))
    same = (F.col(region) == F.col("_of")) & (F.struct(*order) == F.col("_latest"))
    return df.join(winner, same, "left_semi")
