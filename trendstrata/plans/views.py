"""Statistics and documents derived from the test tables.

Each view reads whole tables, so its size follows theirs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstrata.operators.categories import category_lookup
from trendstrata.schemas import CATEGORY_ITEM, RAW_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int, rest: int = 0, key: str = "event_id"):
    return F.col(key) % n == rest


def event_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as dirty raw statistics with the record order ``seq``.

    Bad videos, dates, numbers, flags and regions are put in on purpose.
    """
    e = table(spark, sf_dir, "events")
    key, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    columns = {
        "video_id": F.when(~_every(101), F.concat(F.lit("v"), user)),
        "trending_date": F.when(_every(53, 1), "not-a-date")
        .when(_every(3), F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "yy.dd.MM")),
        "title": F.when(~_every(23), F.concat(F.lit("title "), key)),
        "channel_title": F.concat(F.lit("ch"), user % 17),
        "category_id": F.when(_every(37), "x").otherwise((user % 30).cast("string")),
        "publish_time": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        "tags": kind,
        "views": F.when(_every(11), F.lit(None).cast("string"))
        .when(_every(13), "0")
        .when(_every(59), "12.7")
        .when(_every(61), "abc")
        .otherwise(F.floor(F.col("value") * 100).cast("string")),
        "likes": F.get_json_object("props", "$.k"),
        "dislikes": (key % 3).cast("string"),
        "comment_count": (key % 5).cast("string"),
        "thumbnail_link": F.concat(F.lit("img/"), key),
        "comments_disabled": F.lit("False"),
        "ratings_disabled": F.when(_every(7), "True").otherwise("False"),
        "video_error_or_removed": F.when(_every(19), "maybe").otherwise("False"),
        "description": F.col("props"),
        "region": F.when(_every(97), "")
        .when(_every(5), F.concat(F.lit(" "), F.upper(kind), F.lit(" ")))
        .otherwise(kind),
    }
    return e.select(key.alias("seq"), *[column.alias(name) for name, column in columns.items()])


STAR_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def star_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order tables as raw statistics, one row per line item.

    The record order is ``STAR_ORDER``.
    """
    tables = ("lineitem", "orders", "customer", "nation", "region", "supplier", "part")
    line, orders, customer, nation, region, supplier, part = (table(spark, sf_dir, t) for t in tables)
    joined = (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )
    filled = {
        "video_id": F.concat(F.lit("v"), "l_partkey"),
        "trending_date": F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd"),
        "title": F.col("p_name"),
        "channel_title": F.col("s_name"),
        "category_id": F.col("p_size"),
        "views": F.floor("l_extendedprice"),
        "likes": F.floor("l_quantity"),
        "dislikes": F.col("l_linenumber"),
        "comment_count": F.floor(F.round(F.col("l_discount") * 100)),
    }
    columns = [filled.get(c, F.lit(None)).cast("string").alias(c) for c in RAW_COLUMNS]
    region_code = F.lower(F.substring("r_name", 1, 2)).alias("region")
    return joined.select(*columns, region_code, *STAR_ORDER)


def document_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as raw statistics; descriptions are the whole texts.

    Three documents in a row, where they are of one language, are the same video on the same day.
    """
    d = table(spark, sf_dir, "documents")
    key, size = F.col("doc_id"), F.col("n_chars")
    video = F.floor(key / 3)
    filled = {
        "video_id": F.concat(F.lit("d"), video),
        "trending_date": F.concat(F.lit("24."), F.lpad((video % 7 + 1).cast("string"), 2, "0"), F.lit(".01")),
        "title": F.concat_ws(", ", F.lit('the "text"'), key),
        "channel_title": F.col("source"),
        "category_id": size % 30,
        "publish_time": F.lit("2024-01-31 00:00:00"),
        "tags": F.col("lang"),
        "views": size,
        "likes": size % 100,
        "dislikes": size % 7,
        "comment_count": size % 13,
        "thumbnail_link": F.concat(F.lit("img/"), key),
        "comments_disabled": F.lit("False"),
        "ratings_disabled": F.lit("True"),
        "video_error_or_removed": F.lit("False"),
        "description": F.col("text"),
    }
    columns = [filled[c].cast("string").alias(c) for c in RAW_COLUMNS]
    return d.select(*columns, F.col("lang").alias("region"))


def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as category documents: every line of a text is an item.

    The id is the line length modulo 30, so most ids repeat in a document.  Some
    documents have no items, some have no list of them at all.
    """
    d = table(spark, sf_dir, "documents")
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(
            F.lit("line").alias("kind"),
            F.md5(line).alias("etag"),
            (F.length(line) % 30).cast("string").alias("id"),
            F.struct(
                line.alias("title"), (F.length(line) > 40).alias("assignable"), F.col("source").alias("channelId")
            ).alias("snippet"),
        ),
    )
    none = F.lit(None)
    items = F.when(_every(50, 0, "doc_id"), F.array().cast(f"array<{CATEGORY_ITEM.simpleString()}>")).when(
        ~_every(50, 1, "doc_id"), lines
    )
    folder = F.when(_every(3, 0, "doc_id"), F.concat(F.lit("Region="), F.upper("lang"), F.lit("/"))).otherwise("")
    key = F.concat(F.lit("raw/"), folder, F.col("lang"), F.lit("_category_id_"), F.col("doc_id"), F.lit(".json"))
    return d.select(
        F.lit("document").alias("kind"),
        F.md5("text").alias("etag"),
        none.cast("string").alias("id"),
        none.cast(CATEGORY_ITEM["snippet"].dataType).alias("snippet"),
        items.alias("items"),
        F.col("lang").alias("region"),
        key.alias("_source_file"),
        F.col("doc_id").alias("_document"),
    )


def nation_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation`` as the silver reference of the event and order statistics."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("snippet_title")
    )


def nation_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_lookup(nation_reference(spark, sf_dir))
