from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from trendstrata.functions import (
    decode_key,
    decode_path,
    flatten_struct,
    ingestion_id,
    iso_utc,
    landing_date,
    landing_hour,
    parse_trending_date,
    per_hundred,
    ratio_half_up,
    region_from_key,
    region_from_path,
    text_to_instant,
    to_boolean,
    to_long,
)


def values(spark, given, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_to_long_follows_the_lenient_cast(spark):
    cases = {
        "12": 12, "12.7": 12, "12.": 12, " 7 ": 7, "+5": 5, "-3.9": -3, ".5": 0, "-.5": 0, ".": 0,
        "1e3": None, "": None, "abc": None, "1_0": None, "1.2.3": None, "1.x": None, None: None,
        "99999999999999999999": None, "99999999999999999999.5": None,
        "9223372036854775807": 9223372036854775807, "-9223372036854775808.9": -9223372036854775808,
    }
    assert values(spark, list(cases), to_long) == list(cases.values())


def test_to_boolean(spark):
    cases = {"True": True, "false": False, " true ": True, "1": True, "n": False, "maybe": None, "": None, None: None}
    assert values(spark, list(cases), to_boolean) == list(cases.values())


def test_parse_trending_date(spark):
    cases = {
        "17.14.11": date(2017, 11, 14), "24.01.02": date(2024, 2, 1), "24.31.02": None, "24.13.13": None,
        "2024-03-05": date(2024, 3, 5), "2024-3-5": date(2024, 3, 5), "2024-03-05 10:00:00": date(2024, 3, 5),
        "not-a-date": None, "": None, None: None, "17.14.11 ": None, "17.14.11\n": None, "2024-02-30": None,
    }
    assert values(spark, list(cases), parse_trending_date) == list(cases.values())


def test_region_from_key(spark):
    cases = {
        "raw/reference/region=ca/CA_category_id.json": "ca",
        "raw/reference/REGION=GB/x.json": "gb",
        "raw/reference/CA_category_id.json": "ca",
        "raw/reference/USA_category_id.json": "unknown",
        "raw/reference/other.json": "unknown",
        "a/region=/US_category_id.json": "",
        "a/region=fr=x/US_category_id.json": "fr",
        "a/region= De \t/y.json": "de",
        "a/region=us/region=gb/y.json": "us",
        "a/myregion=us/GB_Category_ID.JSON": "gb",
        "region=jp": "jp",
        "_category_id.json": "unknown",
    }
    assert values(spark, list(cases), region_from_key) == list(cases.values())


def test_region_from_path(spark):
    cases = {
        "file:/r/region=us/a.csv": "us", "file:/r/region=GB/date=x/a.csv": "GB", "file:/r/a.csv": "",
        "file:/r/region=%20De%20/a.csv": " De ", "file:/r/region=us-east/a.csv": "us-east",
    }
    assert values(spark, list(cases), region_from_path) == list(cases.values())


def test_decoding(spark):
    assert values(spark, ["a+b%3Dc", "100%"], decode_key) == ["a b=c", "100%"]
    assert values(spark, ["a+b%3Dc", "100%"], decode_path) == ["a+b=c", "100%"]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_instants_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        given = ["2026-06-07T14:15:30.123456+00:00", "2026-06-07T14:15:30.123456", "2026-06-07T19:45:30.123456+05:30",
                 "2026-06-07T14:15:30.123456Z", "junk", "2026-06-07"]
        micros = values(spark, given, lambda c: F.unix_micros(text_to_instant(c)))
        expected = int(datetime(2026, 6, 7, 14, 15, 30, 123456, timezone.utc).timestamp() * 1_000_000)
        midnight = int(datetime(2026, 6, 7, tzinfo=timezone.utc).timestamp() * 1_000_000)
        assert micros == [expected] * 4 + [None, midnight]
        at = F.timestamp_micros(F.lit(expected))
        shown = spark.range(1).select(iso_utc(at), landing_date(at), landing_hour(at), ingestion_id(at)).first()
        assert tuple(shown) == ("2026-06-07T14:15:30.123456+00:00", "2026-06-07", "14", "20260607_141530")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_per_hundred(spark):
    df = spark.createDataFrame([(1, 3), (5, 0), (5, -2), (2, 32000)], "a long, b long")
    assert [r[0] for r in df.select(per_hundred(F.col("a"), F.col("b"))).collect()] == [33.3333, 0.0, 0.0, 0.0063]


def test_ratio_half_up_is_exact(spark):
    cases = [
        (1, 8, 2, 0.13), (-1, 8, 2, -0.13), (1, -8, 2, -0.13), (5, 1000, 2, 0.01), (4999999, 10**9, 2, 0.0),
        (2, 3, 4, 0.6667), (0, 7, 2, 0.0), (7, 0, 2, None), (10**18, 3, 2, 333333333333333333.33), (-1, 1000, 2, 0.0),
        (123445, 10**6, 4, 0.1234), (12345, 10**5, 4, 0.1235),
    ]
    for top, bottom, scale, expected in cases:
        df = spark.createDataFrame([(top, bottom)], "a long, b long")
        got = df.select(ratio_half_up(F.col("a").cast("decimal(20,0)"), F.col("b"), scale)).first()[0]
        assert got == expected and str(got) == str(expected), (top, bottom, scale, got)


def test_flatten_struct(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('b', 2, 'c.d', named_struct('e', array(3))) AS s")
    flat = flatten_struct(df)
    assert flat.columns == ["a", "s_b", "s_c_d_e"]
    assert tuple(flat.first()) == (1, 2, [3])
