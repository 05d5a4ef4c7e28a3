"""Declared schemas.  Nothing is inferred on the default paths."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Column order of the raw statistics files.
RAW_COLUMNS = (
    "video_id",
    "trending_date",
    "title",
    "channel_title",
    "category_id",
    "publish_time",
    "tags",
    "views",
    "likes",
    "dislikes",
    "comment_count",
    "thumbnail_link",
    "comments_disabled",
    "ratings_disabled",
    "video_error_or_removed",
    "description",
)
LONG_COLUMNS = frozenset({"category_id", "views", "likes", "dislikes", "comment_count"})
BOOLEAN_COLUMNS = frozenset({"comments_disabled", "ratings_disabled", "video_error_or_removed"})
COUNTERS = ("views", "likes", "dislikes", "comment_count")
# Region leads: rows leave the deduplication sorted by key, which is then the
# order in which a table partitioned by region is written.
SILVER_KEY = ("region", "video_id", "trending_date_parsed")


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


RAW_STATISTICS = T.StructType(_strings(*RAW_COLUMNS, CORRUPT))

SNIPPET = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("assignable", T.BooleanType()),
        T.StructField("channelId", T.StringType()),
    ]
)
CATEGORY_ITEM = T.StructType(
    [*_strings("kind", "etag", "id"), T.StructField("snippet", SNIPPET)]
)
ENVELOPE = T.StructType(_strings("ingestion_id", "region", "ingestion_timestamp", "source"))

# Why a document gives no rows.
UNREADABLE = "not a readable document"
WITHOUT_ROWS = "no category rows in the document"

QUALITY_RECORD = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("negative_count", T.LongType()),
        T.StructField("extreme_count", T.LongType()),
        T.StructField("missing_columns", T.ArrayType(T.StringType())),
        T.StructField("latest_record", T.TimestampType()),
        T.StructField("cutoff", T.TimestampType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("message", T.StringType()),
    ]
)

LEDGER = T.StructType(
    [
        *_strings("run_id", "stage", "source", "region"),
        T.StructField("rows_written", T.LongType()),
        *_strings("path", "error"),
        T.StructField("recorded_at", T.TimestampType()),
    ]
)
