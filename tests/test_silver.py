"""Cleansing and deduplication of statistics."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from trendstrata.operators.cleanse import add_ratios, drop_invalid, normalise_region, zero_fill
from trendstrata.operators.dedup import dedup_last, dedup_latest, dedup_tallied, latest_file_per_region
from trendstrata.plans.silver import settle, silver_statistics, stage_measures, tallied_statistics
from trendstrata.plans.views import document_statistics, event_statistics
from trendstrata.schemas import CORRUPT, RAW_COLUMNS, SILVER_KEY

SILVER_COLUMNS = [
    *RAW_COLUMNS, "region", "trending_date_parsed", "like_ratio", "engagement_rate", "_processed_at", "_job_name",
]


def raw(spark, *records):
    columns = [*RAW_COLUMNS, "region", CORRUPT]
    schema = ", ".join(f"{c} string" for c in columns)
    base = dict.fromkeys(columns) | {"video_id": "v", "trending_date": "24.02.01", "views": "10", "region": "us"}
    return spark.createDataFrame([tuple((base | r)[c] for c in columns) for r in records], schema)


def test_layout_and_types(spark):
    silver = silver_statistics(raw(spark, {}))
    assert silver.columns == SILVER_COLUMNS
    types = dict(silver.dtypes)
    assert {types[c] for c in ("category_id", "views", "likes", "dislikes", "comment_count")} == {"bigint"}
    assert {types[c] for c in ("comments_disabled", "ratings_disabled", "video_error_or_removed")} == {"boolean"}
    assert (types["trending_date_parsed"], types["like_ratio"], types["_processed_at"]) == ("date", "double", "timestamp")


def test_invalid_rows_go(spark, rows):
    df = spark.createDataFrame(
        [("a", " US "), (None, "us"), ("b", ""), ("c", None), ("d", "  "), ("", "gb")], "video_id string, region string"
    )
    assert rows(drop_invalid(normalise_region(df))) == [("", "gb"), ("a", "us")]


def test_zero_fill_and_ratios(spark, rows):
    df = spark.createDataFrame([(None, 1, None, 2), (200, 3, 1, 2), (-5, 1, 1, 1)],
                               "views long, likes long, dislikes long, comment_count long")
    done = add_ratios(zero_fill(df))
    assert rows(done) == [(-5, 1, 1, 1, 0.0, 0.0), (0, 1, 0, 2, 0.0, 0.0), (200, 3, 1, 2, 1.5, 3.0)]


def test_nonsense_counters_do_not_stop_the_job(spark):
    huge = str(2**63 - 1)
    row = silver_statistics(raw(spark, {"views": "1", "likes": huge, "dislikes": huge, "comment_count": huge})).first()
    assert row["engagement_rate"] > 1e21


def test_unparsed_dates_are_one_key(spark):
    silver = silver_statistics(raw(spark, {"trending_date": "x", "views": "1"}, {"trending_date": None, "views": "2"}))
    assert [(r["views"], r["trending_date_parsed"]) for r in silver.collect()] == [(2, None)]


def test_both_date_forms_meet_in_one_key(spark):
    silver = silver_statistics(raw(spark, {"views": "1"}, {"trending_date": "2024-01-02", "views": "3"}))
    assert [(r["views"], r["trending_date_parsed"]) for r in silver.collect()] == [(3, date(2024, 1, 2))]


def test_winner_does_not_depend_on_row_order(spark, sf_dir):
    # Without the record order the content alone decides; shuffled input agrees.
    events = event_statistics(spark, sf_dir).drop("seq")
    keep = [c for c in SILVER_COLUMNS if c != "_processed_at"]
    first = silver_statistics(events).select(*keep)
    again = silver_statistics(events.repartition(5, F.rand(7))).select(*keep)
    assert first.exceptAll(again).isEmpty() and again.exceptAll(first).isEmpty()


@pytest.mark.parametrize("order", [["seq"], None])
def test_tallied_result_equals_the_plain_one(spark, sf_dir, order):
    events = event_statistics(spark, sf_dir)
    options = {"order": order} if order else {}
    plain = silver_statistics(events, **options).drop("_processed_at")
    tallied = settle(tallied_statistics(events, **options)).drop("_processed_at").select(*plain.columns)
    assert plain.exceptAll(tallied).isEmpty() and tallied.exceptAll(plain).isEmpty()


def test_measures_account_for_every_row(spark):
    df = raw(spark, {}, {"title": "t"}, {"video_id": None}, {"region": " "}, {"video_id": "w", "views": "-4", CORRUPT: "w"})
    got = tallied_statistics(df).agg(*stage_measures()).first().asDict()
    assert got == {
        "rows_read": 5, "rows_corrupt": 1, "rows_clean": 2, "rows_removed": 3, "null_video_id": 0, "null_title": 1,
        "null_channel_title": 2, "null_views": 0, "negative_views": 1,
    }


def test_measures_of_nothing(spark):
    got = tallied_statistics(raw(spark, {}).limit(0)).agg(*stage_measures()).first()
    assert (got["rows_read"], got["rows_corrupt"], got["rows_clean"], got["rows_removed"]) == (0, 0, 0, 0)


def test_one_hot_key(spark):
    """A third of all rows under one key: one row per task reaches the shuffle."""
    df = spark.range(0, 30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("o")
    )
    latest = dedup_latest(df, ["k"], ["o"])
    tallied = dedup_tallied(df, ["k"], ["o"], {"n": F.count(F.lit(1))})
    assert latest.count() == tallied.count() == 20_001
    assert latest.filter("k = 0").first()["o"] == 29_997
    assert tuple(tallied.filter("k = 0").first()) == (0, 29_997, 10_000)


def test_null_orders_lose(spark, rows):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("b", None, 3)], "k string, o int, x int")
    assert rows(dedup_latest(df, ["k"], ["o"])) == [("a", 5, 2), ("b", None, 3)]
    assert rows(dedup_tallied(df, ["k"], ["o"], {})) == [("a", 5, 2), ("b", None, 3)]


def test_dedup_last(spark, rows):
    df = spark.createDataFrame([("f", "1", 0), ("f", "1", 2), ("f", None, 1), ("f", None, 3), ("g", "1", 0)],
                               "file string, id string, pos int")
    assert rows(dedup_last(df, ["file", "id"], "pos")) == [("f", None, 3), ("f", "1", 2), ("g", "1", 0)]


def test_latest_file_per_region(spark, rows):
    df = spark.createDataFrame([("us", "a", 1), ("us", "b", 2), ("us", "b", 3), ("gb", "a", 4)],
                               "region string, _source_file string, x int")
    assert rows(latest_file_per_region(df), "x") == [(2,), (3,), (4,)]


def test_silver_key_is_unique(spark, sf_dir):
    silver = silver_statistics(document_statistics(spark, sf_dir))
    assert silver.count() == silver.select(*SILVER_KEY).distinct().count() > 0
