"""What arrived, what was written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstrata.functions import strip

# The two documents each region lands per run, in landing order.
LANDING_KINDS = ("trending", "categories")


def expected_regions(spark: SparkSession, regions: Sequence[str]) -> DataFrame:
    """The configured region list as rows."""
    listed = spark.range(1).select(F.explode(F.array(*[F.lit(r) for r in regions])).alias("region"))
    return listed.select(_region().alias("region"))


def _region() -> Column:
    return strip(F.lower("region"))


def landing_audit(
    landed: DataFrame, expected: DataFrame, kinds: Sequence[str] = LANDING_KINDS
) -> DataFrame:
    """Each expected region with ``success`` or ``failed`` and the first missing kind.

    ``landed`` has ``region`` and ``kind``.  It shrinks to one row per region
    before the join.
    """
    seen = (
        landed.select(_region().alias("region"), "kind")
        .groupBy("region")
        .agg(*[F.bool_or(F.col("kind") == kind).alias(f"_has_{kind}") for kind in kinds])
    )
    missing = F.coalesce(
        *[F.when(~F.coalesce(F.col(f"_has_{kind}"), F.lit(False)), F.lit(kind)) for kind in kinds]
    )
    return expected.join(seen, "region", "left").select(
        "region",
        F.when(missing.isNull(), F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        missing.alias("failed_kind"),
    )


def _landed_regions(landed: DataFrame) -> DataFrame:
    return landed.select(_region().alias("region")).distinct()


def missing_regions(landed: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected regions of which nothing landed."""
    return expected.join(_landed_regions(landed), "region", "left_anti")


def present_regions(landed: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected regions of which something landed."""
    return expected.join(_landed_regions(landed), "region", "left_semi")
