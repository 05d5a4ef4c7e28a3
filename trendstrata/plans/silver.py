"""Raw statistics to the silver table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstrata.operators.cleanse import (
    add_ratios,
    drop_invalid,
    enforce_schema,
    is_valid,
    normalise_region,
    parse_dates,
    stamp,
    zero_fill,
)
from trendstrata.operators.dedup import dedup_latest, dedup_tallied
from trendstrata.operators.quality import warning_measures
from trendstrata.schemas import CORRUPT, RAW_COLUMNS, SILVER_KEY

# Among equal copies the counters decide, since they only grow; the remaining
# columns make the choice independent of row order.
CONTENT_ORDER = (
    "views",
    "likes",
    "comment_count",
    "dislikes",
    *[c for c in RAW_COLUMNS if c not in ("views", "likes", "comment_count", "dislikes")],
)


def typed_statistics(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Typed and normalised, with the parsed date and filled counters."""
    return zero_fill(parse_dates(normalise_region(enforce_schema(raw, carry))))


def _finish(df: DataFrame, job_name: str, processed_at: Column | None) -> DataFrame:
    return stamp(add_ratios(df), job_name, processed_at)


def silver_statistics(
    raw: DataFrame,
    job_name: str = "bronze_to_silver",
    order: Sequence[str] = CONTENT_ORDER,
    processed_at: Column | None = None,
) -> DataFrame:
    """Clean statistics, one row per video, region and day.

    ``order`` names the columns whose greatest values win; columns of it that
    are not part of the raw layout are carried through to the result.  Ratios
    and stamps are added after the deduplication: they are the same for the
    kept row and need not be shuffled.
    """
    carry = [c for c in order if c not in RAW_COLUMNS]
    clean = drop_invalid(typed_statistics(raw, carry))
    return _finish(dedup_latest(clean, SILVER_KEY, order), job_name, processed_at)


# What a rejected row keeps: where it stood, its text, and how many rows of the file read the same.
REJECT_COLUMNS = ("region", "_source_file", CORRUPT, "rows")
GOOD, REJECTS = "good", "rejects"


def tallied_statistics(
    raw: DataFrame,
    job_name: str = "bronze_to_silver",
    order: Sequence[str] = CONTENT_ORDER,
    processed_at: Column | None = None,
    drop_corrupt: bool = False,
    stored: DataFrame | None = None,
    stored_rejects: DataFrame | None = None,
) -> DataFrame:
    """As ``silver_statistics``, with the bookkeeping of every raw row.

    ``_copies`` and ``_corrupt_rows`` tell how many raw rows each result row
    stands for.  Unusable rows share one key per task and arrive as a single
    row with ``_valid`` false.  With ``drop_corrupt`` corrupt rows are unusable
    too, and each text of a file arrives as a row of its own, with the text in the
    corrupt column and its number in ``rows``.  Aggregating ``stage_measures`` over
    this accounts for all rows read, in the same pass.

    ``stored`` and ``stored_rejects`` are rows of an earlier result that these are
    merged with: a row that was there stays, with its stamps, unless a raw row is greater.
    """
    carry = [c for c in order if c not in RAW_COLUMNS]
    broken = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    marked = raw.withColumns({"_is_corrupt": broken, "_was": F.lit(None).cast("struct<at: timestamp, job: string>")})
    usable = is_valid() & ~F.col("_is_corrupt") if drop_corrupt else is_valid()
    texts = [CORRUPT, "_source_file"] if drop_corrupt else []
    typed = typed_statistics(marked, [*carry, *texts, "_is_corrupt", "_was"])
    typed = typed.withColumns({"_valid": usable, "_stored": F.lit(False), "_rows": F.lit(1).cast("long")})
    if stored is not None:
        was = F.struct(F.col("_processed_at").alias("at"), F.col("_job_name").alias("job"))
        held = {"_valid": F.lit(True), "_stored": F.lit(True), "_is_corrupt": F.lit(False), "_was": was, "_rows": F.lit(0).cast("long")}
        held_rows = stored.withColumns(held)
        typed = typed.unionByName(held_rows.select(*[c for c in typed.columns if c in held_rows.columns]), allowMissingColumns=True)
    if stored_rejects is not None:
        held = {"_valid": F.lit(False), "_stored": F.lit(True), "_is_corrupt": F.lit(True), "_rows": F.col("rows")}
        typed = typed.unionByName(stored_rejects.withColumns(held).drop("rows"), allowMissingColumns=True)
    keyed = typed.withColumns({key: F.when(F.col("_valid"), F.col(key)) for key in SILVER_KEY if key != "region"})
    set_apart = F.lit(False)
    keys = [*SILVER_KEY, "_valid"]
    if drop_corrupt:
        set_apart = F.col("_is_corrupt")
        keyed = keyed.withColumns({c: F.when(set_apart, F.col(c)) for c in texts})
        keys += texts
    keyed = keyed.withColumn("region", F.when(F.col("_valid") | set_apart, F.col("region")))
    tallies = {
        "_copies": F.count_if(~F.col("_stored")),
        "_corrupt_rows": F.count_if(F.col("_is_corrupt") & ~F.col("_stored")),
        "rows": F.sum("_rows"),
    }
    kept = dedup_tallied(keyed, keys, [*order, "_stored"], tallies).drop("_is_corrupt", "_stored", "_rows")
    when = F.current_timestamp() if processed_at is None else processed_at
    done = add_ratios(kept).withColumns(
        {"_processed_at": F.coalesce("_was.at", when), "_job_name": F.coalesce("_was.job", F.lit(job_name))}
    )
    return done.drop("_was") if drop_corrupt else done.drop("_was", "rows")


def stage_measures() -> list[Column]:
    """Rows read, corrupt, clean and removed, and the warnings, over tallied rows."""
    read = F.coalesce(F.sum("_copies"), F.lit(0))
    clean = F.count_if("_valid")
    return [
        read.alias("rows_read"),
        F.coalesce(F.sum("_corrupt_rows"), F.lit(0)).alias("rows_corrupt"),
        clean.alias("rows_clean"),
        (read - clean).alias("rows_removed"),
        *warning_measures(F.col("_valid")),
    ]


def settle(tallied: DataFrame) -> DataFrame:
    """The silver rows of a tallied result."""
    return tallied.filter("_valid").drop("_valid", "_copies", "_corrupt_rows", CORRUPT, "_source_file", "rows")


def routed(tallied: DataFrame) -> DataFrame:
    """Silver rows and set-apart rows of one tallied result, told apart by ``kind``."""
    kind = F.when(F.col("_valid"), GOOD).when(F.col(CORRUPT).isNotNull(), REJECTS)
    return tallied.withColumn("kind", kind).filter(F.col("kind").isNotNull()).drop("_valid", "_copies", "_corrupt_rows")
