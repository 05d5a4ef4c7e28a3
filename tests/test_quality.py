"""The checks at and around their limits."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from trendstrata.config import Settings
from trendstrata.operators import quality

NOW = datetime(2024, 1, 31, 12, tzinfo=timezone.utc)
STATISTICS = "clean_statistics"
SCHEMA = "video_id string, title string, channel_title string, views long, region string, _processed_at timestamp"


def statistics(spark, n=20, untitled=0, views=(), stamp=NOW):
    views = [*views, *[5] * (n - len(views))]
    data = [(f"v{i}", None if i < untitled else "t", "c", views[i], "us", stamp) for i in range(n)]
    return spark.createDataFrame(data, SCHEMA)


def records(df, table=STATISTICS, settings=None):
    checked = quality.check_table(df, table, settings, F.lit(NOW)).collect()
    return {(r["check"], r["column"]): r for r in checked}


def passed(df, check, column=None, table=STATISTICS):
    return records(df, table)[(check, column)]["passed"]


def test_clean_tables_give_fourteen_records(spark):
    reference = spark.range(10).select(
        F.col("id").cast("string").alias("id"), F.lit("us").alias("region"),
        F.lit("2024-01-31T11:00:00.5+00:00").alias("_ingestion_timestamp"),
    )
    tables = {STATISTICS: lambda: statistics(spark), "clean_reference_data": lambda: reference}
    results = quality.run_checks(spark, tables, now=F.lit(NOW))
    assert tuple(quality.summarise(results).first()) == (True, 14, 14)
    assert results.dtypes == quality.check_table(reference, "x").dtypes
    lazily = quality.check_tables({name: make() for name, make in tables.items()}, now=F.lit(NOW))
    assert lazily.exceptAll(results).isEmpty()


def test_row_count(spark):
    assert not passed(statistics(spark, 9), "row_count")
    assert passed(statistics(spark, 10), "row_count")


def test_null_share(spark):
    assert passed(statistics(spark, 20, untitled=1), "null_pct", "title")
    assert not passed(statistics(spark, 1999, untitled=100), "null_pct", "title")
    record = records(statistics(spark, 1999, untitled=100))[("null_pct", "title")]
    assert (record["value"], record["threshold"]) == (5.0, 5.0)
    assert passed(statistics(spark, 0), "null_pct", "title")


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "views double")
    settings = Settings(critical_columns={"t": ["views"]})
    assert records(df, "t", settings)[("null_pct", "views")]["value"] == 50.0


def test_missing_column(spark):
    got = records(statistics(spark).drop("channel_title", "title"))
    assert not got[("null_pct", "channel_title")]["passed"]
    assert got[("null_pct", "channel_title")]["value"] is None
    assert (got[("schema", None)]["passed"], got[("schema", None)]["missing_columns"]) == (
        False, ["channel_title", "title"],
    )


@pytest.mark.parametrize("views,negative,extreme", [
    ([-1], 1, 0), ([50_000_000_001], 0, 1), ([50_000_000_000], 0, 0), ([None, -2, -3], 2, 0), ([0], 0, 0),
])
def test_value_range(spark, views, negative, extreme):
    record = records(statistics(spark, views=views))[("value_range", "views")]
    assert (record["negative_count"], record["extreme_count"]) == (negative, extreme)
    assert record["passed"] == (negative == extreme == 0)


def test_value_range_only_where_asked(spark):
    assert ("value_range", "views") not in records(statistics(spark), "clean_reference_data")
    assert ("value_range", "views") not in records(statistics(spark).drop("views"))


def test_freshness_limit(spark):
    limit = NOW - timedelta(hours=48)
    assert passed(statistics(spark, stamp=limit), "freshness")
    assert not passed(statistics(spark, stamp=limit - timedelta(seconds=1)), "freshness")
    assert records(statistics(spark, stamp=limit))[("freshness", None)]["latest_record"] == limit.replace(tzinfo=None)


@pytest.mark.parametrize("stamps,expected", [
    (["2024-01-31T10:00:00+00:00", "2020-01-01"], True),
    (["2020-01-01"], False),
    (["2024-01-29T12:00:00"], True),
    (["2024-01-29T13:00:00+02:00"], False),
    (["junk", "2020-01-01"], True),
    ([None, "2020-01-01"], False),
    ([None], False),
    ([], False),
])
def test_freshness_of_text(spark, stamps, expected):
    df = spark.createDataFrame([(s,) for s in stamps], "_ingestion_timestamp string")
    assert passed(df, "freshness", table="clean_reference_data") == expected


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_zoneless_stamps_mean_utc(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for text, expected in (("2024-01-29 12:00:00", True), ("2024-01-29 11:59:59", False)):
            df = spark.range(1).select(F.lit(text).cast("timestamp_ntz").alias("_processed_at"))
            assert passed(df, "freshness") == expected
            assert passed(df.select(F.col("_processed_at").cast("string")), "freshness") == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_freshness_without_stamp_and_with_both(spark):
    assert passed(statistics(spark).drop("_processed_at"), "freshness")
    both = statistics(spark).withColumn("_ingestion_timestamp", F.lit("2000-01-01"))
    assert passed(both, "freshness")


def test_unlisted_table(spark):
    assert set(records(statistics(spark), "other")) == {("row_count", None), ("schema", None), ("freshness", None)}


def test_unreadable_table_fails_alone(spark):
    def absent():
        return spark.table("nowhere_to_be_found")

    results = quality.run_checks(spark, {"gone": absent, STATISTICS: lambda: statistics(spark)}, now=F.lit(NOW))
    verdict = quality.summarise(results).first()
    assert tuple(verdict) == (False, 9, 10)
    assert [r["check"] for r in quality.alerts(results).collect()] == ["read_table"]


def test_table_whose_files_are_gone_fails_alone(spark, tmp_path):
    path = str(tmp_path / "files")
    statistics(spark).write.parquet(path)
    broken = spark.read.parquet(path)
    for file in (tmp_path / "files").glob("*.parquet"):
        file.write_bytes(b"not parquet")
    results = quality.run_checks(spark, {STATISTICS: lambda: broken})
    assert [r["check"] for r in results.collect()] == ["read_table"]


def test_gate(spark):
    good = quality.run_checks(spark, {STATISTICS: lambda: statistics(spark)}, now=F.lit(NOW))
    assert quality.gate(good, lambda: "built") == "built"
    bad = quality.run_checks(spark, {STATISTICS: lambda: statistics(spark, 9)}, now=F.lit(NOW))
    with pytest.raises(quality.QualityGateError, match="1 of 9"):
        quality.gate(bad, lambda: pytest.fail("must not run"))
    assert quality.gate(good.limit(0), lambda: "no records pass") == "no records pass"


def test_silver_warnings(spark):
    got = quality.silver_warnings(statistics(spark, untitled=3, views=[-1, None])).first().asDict()
    assert got == {"null_video_id": 0, "null_title": 3, "null_channel_title": 0, "null_views": 1, "negative_views": 1}


def test_failures_have_the_record_layout(spark):
    bad = spark.createDataFrame([("f.json", "empty")], "file string, why string")
    failed = quality.failures(bad, "read_file", F.col("file"), F.col("why"))
    assert failed.dtypes == quality.unreadable(spark, "t", "r").dtypes
    row = failed.first()
    assert (row["check"], row["table"], row["passed"], row["message"]) == ("read_file", "f.json", False, "empty")
