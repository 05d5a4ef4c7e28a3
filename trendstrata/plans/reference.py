"""Category documents to the silver reference table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstrata.functions import region_from_key
from trendstrata.operators.categories import flatten_categories, gives_rows, stamp_reference
from trendstrata.operators.dedup import latest_file_per_region

# Which file of a region counts.
BY_KEY = ("_order",)
BY_ARRIVAL = ("_modified_at", "_order")


def reference_rows(docs: DataFrame, at: Column | None = None) -> DataFrame:
    """Rows of every readable document."""
    return stamp_reference(flatten_categories(docs), at)


def folder_of(key: Column) -> Column:
    return F.regexp_extract(key, "^(.*)/", 1)


def with_order(docs: DataFrame) -> DataFrame:
    """``_order``: the key, for landed documents with the time of landing before the file name."""
    key = F.col("_source_file")
    if "_landed_at" not in docs.columns:
        return docs.withColumn("_order", key)
    landed = F.concat_ws("/", folder_of(key), "_landed_at", F.regexp_extract(key, "([^/]*)$", 1))
    return docs.withColumn("_order", F.when(F.col("_landed_at") == "", key).otherwise(landed))


def current_documents(docs: DataFrame, order: Sequence[str] = BY_KEY) -> DataFrame:
    """The documents of each region's last file; files without rows do not count.

    Within a folder, the time in the envelope of a landed document stands before
    the name of its file, since the names of landed files mean nothing.
    """
    usable = with_order(docs).filter(gives_rows(docs)).withColumn("_region", region_from_key(F.col("_source_file")))
    return latest_file_per_region(usable, order, "_region").drop("_region", "_order")


def silver_reference(docs: DataFrame, order: Sequence[str] = BY_KEY, at: Column | None = None) -> DataFrame:
    """Rows of the one file that counts per region.

    Files are chosen before any document is taken apart.  ``docs`` is used
    twice, and not kept in between: the choice shuffles one short row per region
    and task, and whether a document can be read is decided on its whole text.
    """
    return reference_rows(current_documents(docs, order), at).drop("_modified_at")
