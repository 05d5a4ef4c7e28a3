"""Category documents to rows, and category names for statistics."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendstrata.config import UNKNOWN_CATEGORY
from trendstrata.functions import flatten_struct, iso_utc, region_from_key, to_long
from trendstrata.operators.dedup import dedup_last
from trendstrata.schemas import CORRUPT, UNREADABLE, WITHOUT_ROWS

_LINEAGE = ("_source_file", "_modified_at", "_document")


def _is_readable(docs: DataFrame) -> Column:
    return F.col(CORRUPT).isNull() if CORRUPT in docs.columns else F.lit(True)


def _shaped(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """``column`` with the fields of ``want``; those it lacks are NULL."""
    if not (isinstance(have, T.StructType) and isinstance(want, T.StructType)):
        return column.cast(want)
    known = {f.name: f.dataType for f in have.fields}
    fields = [
        _shaped(column[f.name], known[f.name], f.dataType) if f.name in known else F.lit(None).cast(f.dataType)
        for f in want.fields
    ]
    shaped = F.struct(*[c.alias(f.name) for c, f in zip(fields, want.fields)])
    return F.when(column.isNotNull(), shaped)


def _whole_document(docs: DataFrame, item: T.StructType) -> Column:
    """The document itself in the shape of an item."""
    fields = [
        _shaped(F.col(f"`{f.name}`"), docs.schema[f.name].dataType, f.dataType)
        if f.name in docs.columns and f.name != "items"
        else F.lit(None).cast(f.dataType)
        for f in item.fields
    ]
    return F.struct(*[c.alias(f.name) for c, f in zip(fields, item.fields)])


def _has_field(value: Column, kind: T.DataType) -> Column:
    """Whether anything inside is not NULL."""
    if not isinstance(kind, T.StructType):
        return value.isNotNull()
    return reduce(or_, [_has_field(value[f.name], f.dataType) for f in kind.fields], F.lit(False))


def gives_rows(docs: DataFrame) -> Column:
    """Readable, and some item, or without a list of them the document itself, has a field."""
    item = docs.schema["items"].dataType.elementType
    listed = F.exists("items", lambda entry: _has_field(entry, item))
    whole = _has_field(_whole_document(docs, item), item)
    return _is_readable(docs) & F.when(F.col("items").isNull(), whole).otherwise(listed)


def flatten_categories(docs: DataFrame) -> DataFrame:
    """One flat row per category.

    A document without a list of items counts as one item; in a document the
    last item of an id wins, as long as any of its items has an id at all.
    The lineage columns of the documents stay.
    """
    item = docs.schema["items"].dataType.elementType
    lineage = [c for c in _LINEAGE if c in docs.columns]
    entries = F.coalesce(F.col("items"), F.array(_whole_document(docs, item)))
    exploded = (
        docs.filter(gives_rows(docs))
        .withColumn("_entries", entries)
        .withColumn("_has_id", F.exists("_entries", lambda entry: entry["id"].isNotNull()))
        .select(*lineage, "_has_id", F.posexplode("_entries").alias("_position", "_item"))
        .withColumn("_slot", F.when(~F.col("_has_id"), F.col("_position")))
    )
    flat = flatten_struct(exploded.select(*lineage, "_slot", "_position", "_item.*"))
    keys = ["_document"] if "_document" in lineage else ["_source_file"]
    last = dedup_last(flat, [*keys, "id", "_slot"], "_position")
    return last.withColumn("id", F.col("id").cast("string")).drop("_slot", "_position", "_document")


def empty_documents(docs: DataFrame) -> DataFrame:
    """Documents that give no rows, with the reason."""
    error = F.when(~_is_readable(docs), F.lit(UNREADABLE)).when(
        ~gives_rows(docs), F.lit(WITHOUT_ROWS)
    )
    return docs.select("_source_file", error.alias("error")).filter(F.col("error").isNotNull())


def stamp_reference(rows: DataFrame, at: Column | None = None) -> DataFrame:
    """Region from the file key and the time of ingestion as ISO text."""
    when = F.current_timestamp() if at is None else at
    ordered = [c for c in rows.columns if c not in ("_source_file", "_modified_at")]
    trailing = [c for c in ("_modified_at",) if c in rows.columns]
    return rows.withColumns(
        {"region": region_from_key(F.col("_source_file")), "_ingestion_timestamp": iso_utc(when)}
    ).select(*ordered, "region", "_ingestion_timestamp", "_source_file", *trailing)


def category_lookup(reference: DataFrame) -> DataFrame | None:
    """One name per numeric category id, or None where there is no title column.

    Ids repeat over regions; the alphabetically first name is taken so that
    every run agrees.
    """
    titles = [c for c in ("snippet_title", "snippet.title") if c in reference.columns]
    if "id" not in reference.columns or not titles:
        return None
    return (
        reference.select(to_long(F.col("id")).alias("category_id"), F.col(f"`{titles[0]}`").alias("_name"))
        .filter(F.col("category_id").isNotNull())
        .groupBy("category_id")
        .agg(F.min("_name").alias("category_name"))
    )


def join_categories(stats: DataFrame, lookup: DataFrame) -> DataFrame:
    """Category names beside the statistics; unmatched rows stay.

    No broadcast hint: Spark broadcasts the lookup when its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where
    adaptive execution splits a hot category.
    """
    typed = stats.withColumn("category_id", F.col("category_id").try_cast("long"))
    return typed.join(lookup, "category_id", "left")


def with_category_name(stats: DataFrame) -> DataFrame:
    """Guarantee ``category_name``."""
    unknown = F.lit(UNKNOWN_CATEGORY)
    known = "category_name" in stats.columns
    return stats.withColumn("category_name", F.coalesce("category_name", unknown) if known else unknown)


def name_categories(stats: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Join the names when there is a lookup; ``Unknown`` everywhere else."""
    return with_category_name(stats if lookup is None else join_categories(stats, lookup))
