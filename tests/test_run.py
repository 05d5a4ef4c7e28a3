"""Whole runs over temporary folders, in batch and as files arrive."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from trendstrata.config import Settings
from trendstrata.operators.quality import QualityGateError
from trendstrata.plans.run import Places, Run
from trendstrata.plans.reference import silver_reference
from trendstrata.schemas import RAW_COLUMNS
from trendstrata.sources import read_category_json
from trendstrata.streaming import drain_reference


def raw_line(n, day, views):
    values = dict.fromkeys(RAW_COLUMNS, "") | {
        "video_id": f"v{n}", "trending_date": f"24.{day:02d}.01", "title": f"t{n}", "channel_title": f"c{n % 3}",
        "category_id": str(n % 4), "views": str(views), "likes": "1", "dislikes": "0", "comment_count": "1",
    }
    return ",".join(values[c] for c in RAW_COLUMNS)


def document(*titles):
    items = [{"kind": "k", "etag": "e", "id": str(i), "snippet": {"title": t}} for i, t in enumerate(titles)]
    return json.dumps({"items": items}, indent=1)


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture
def run(spark, tmp_path):
    for region in ("us", "gb"):
        lines = [",".join(RAW_COLUMNS), *[raw_line(n, 1 + n % 2, 100 + n) for n in range(12)], raw_line(0, 1, 50)]
        put(tmp_path / f"raw/region={region}/a.csv", "\n".join([*lines, "v1,24.01.01,short"]) + "\n")
        put(tmp_path / f"reference/region={region}/{region}_category_id.json", document(*"ABCDEFGHIJ"))
    put(tmp_path / "reference/region=fr/bad.json", "{")
    settings = Settings(silver_db=f"silver_{tmp_path.name}", gold_db=f"gold_{tmp_path.name}", max_null_pct=10.0)
    places = Places(*[str(tmp_path / p) for p in ("raw", "reference", "silver", "gold", "ledger", "alerts")])
    yield Run(spark, places, settings, run_id="r1")
    for database in (settings.silver_db, settings.gold_db):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def contents(spark, run):
    s = run.settings
    names = [f"{s.silver_db}.{t}" for t in (s.statistics_table, s.reference_table)]
    names += [f"{s.gold_db}.{t}" for t in ("trending_analytics", "channel_analytics", "category_analytics")]
    skip = {"_processed_at", "_ingestion_timestamp", "_aggregated_at"}
    found = {}
    for name in names:
        df = spark.table(name)
        found[name] = sorted(map(str, df.select(*[c for c in df.columns if c not in skip]).collect()))
    return found


def test_everything_and_again(spark, run):
    written = run.everything()
    assert written == {"trending_analytics": 4, "channel_analytics": 6, "category_analytics": 8}
    first = contents(spark, run)
    # The corrupt short row is set apart.
    stats = spark.table(f"{run.settings.silver_db}.clean_statistics")
    assert stats.count() == 24 and stats.filter("views = 50").isEmpty()
    assert run.everything() == written
    assert contents(spark, run) == first

    ledger = spark.read.parquet(run.places.ledger)
    noted = {(r["stage"], r["source"], r["rows_written"]) for r in ledger.filter("error IS NULL").collect()}
    assert ("silver_statistics", "clean_statistics", 24) in noted
    assert ("gold", "channel_analytics", 6) in noted and ("category_lookup", "clean_reference_data", 10) in noted
    assert {r["rows_written"] for r in ledger.filter("stage = 'silver_reference' AND region = 'us'").collect()} == {10}
    assert ledger.filter("source LIKE '%region=fr/bad.json' AND error IS NOT NULL").count() == 2
    assert {r["check"] for r in spark.read.parquet(run.places.alerts).collect()} == {"read_file"}


def test_statistics_accounts(spark, run):
    run.prepare()
    kept = run.statistics(drop_corrupt=False)
    assert {k: kept[k] for k in ("rows", "rows_read", "rows_corrupt", "rows_clean", "rows_removed")} == {
        "rows": 26, "rows_read": 28, "rows_corrupt": 2, "rows_clean": 26, "rows_removed": 2,
    }
    counts = run.statistics()
    assert (counts["rows_read"], counts["rows_corrupt"], counts["rows"], counts["rejects"]) == (28, 2, 24, 2)
    rejects = spark.table(f"{run.settings.silver_db}.rejected_statistics")
    assert sorted(map(tuple, rejects.select("region", "_corrupt_record", "rows").collect())) == [
        ("gb", "v1,24.01.01,short", 1), ("us", "v1,24.01.01,short", 1),
    ]
    assert {r[0].rsplit("/", 2)[1] for r in rejects.select("_source_file").collect()} == {"region=gb", "region=us"}


def test_a_failed_gold_stage_leaves_the_tables(spark, run, monkeypatch):
    run.everything()
    first = contents(spark, run)
    monkeypatch.setattr(
        "trendstrata.plans.gold.channel_analytics", lambda stats, *_: stats.withColumn("x", F.raise_error(F.lit("lost")).cast("int"))
    )
    with pytest.raises(Exception, match="lost"):
        run.gold()
    assert contents(spark, run) == first


def test_a_failed_silver_stage_is_noted(spark, run):
    run.prepare()
    with pytest.raises(Exception, match="FAILED_READ_FILE|encoding|charset|UNSUPPORTED|INVALID"):
        run.statistics(encoding="no-such-charset")
    ledger = spark.read.parquet(run.places.ledger)
    assert ledger.filter("stage = 'silver_statistics' AND error IS NOT NULL").count() == 1
    assert [r["check"] for r in spark.read.parquet(run.places.alerts).collect()] == ["silver_statistics"]


def test_a_region_that_left_the_feed_is_gone(spark, run, tmp_path):
    run.everything()
    run.places = replace(run.places, raw_statistics=str(tmp_path / "raw/region=us"))
    run.statistics()
    run.gold()
    names = [f"{run.settings.silver_db}.clean_statistics"]
    names += [f"{run.settings.gold_db}.{t}" for t in ("trending_analytics", "channel_analytics", "category_analytics")]
    for name in names:
        assert [r[0] for r in spark.table(name).select("region").distinct().collect()] == ["us"]


def test_gate_stops_gold(spark, run):
    run.settings = Settings(silver_db=run.settings.silver_db, gold_db=run.settings.gold_db, min_rows=1000)
    with pytest.raises(QualityGateError):
        run.everything()
    assert not spark.catalog.tableExists(f"{run.settings.gold_db}.trending_analytics")
    assert "row_count" in {r["check"] for r in spark.read.parquet(run.places.alerts).collect()}
    assert spark.read.parquet(run.places.ledger).filter("stage = 'gate' AND error IS NOT NULL").count() == 1


def test_gold_without_reference(spark, run):
    run.prepare()
    run.statistics()
    run.gold()
    names = spark.table(f"{run.settings.gold_db}.category_analytics").select("category_name").distinct().collect()
    assert [r[0] for r in names] == ["Unknown"]


def test_empty_feed(spark, run, tmp_path):
    run.places = Places(*[str(tmp_path / p) for p in ("no", "nothing", "s", "g", "l", "a")])
    run.prepare()
    assert run.statistics() == {"rows": 0} and run.reference() == {"rows": 0}
    results = {r["check"] for r in run.checks().collect()}
    assert results == {"read_table"}


def test_landing_alerts(spark, run):
    landed = spark.createDataFrame([("us", "trending"), ("us", "categories")], "region string, kind string")
    audit = run.landing(landed, ["us", "gb"])
    assert audit.filter("status = 'success'").count() == 1
    assert [r["table"] for r in spark.read.parquet(run.places.alerts).collect()] == ["gb"]


def streamed(spark, tmp_path, name, **options):
    drain_reference(
        spark, str(tmp_path / "landing"), name, str(tmp_path / "table"), str(tmp_path / "progress"),
        str(tmp_path / "rejects"), **options,
    )


@pytest.fixture
def stream_table(spark, tmp_path):
    name = f"s_{tmp_path.name}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_arrivals(spark, tmp_path, stream_table, rows):
    landing = tmp_path / "landing"
    put(landing / "region=us/date=2/us_category_id.json", document("A"))
    put(landing / "region=gb/date=1/gb_category_id.json", document("B", "C"))
    streamed(spark, tmp_path, stream_table)
    table = spark.table(stream_table)
    assert rows(table, "region", "snippet_title") == [("gb", "B"), ("gb", "C"), ("us", "A")]
    # An earlier key that lands later replaces its region; the others stay.
    put(landing / "region=us/date=1/us_category_id.json", document("Z", "Y"))
    put(landing / "region=fr/date=1/fr_category_id.json", json.dumps({"items": []}))
    streamed(spark, tmp_path, stream_table)
    assert rows(spark.table(stream_table), "region", "snippet_title") == [("gb", "B"), ("gb", "C"), ("us", "Y"), ("us", "Z")]
    assert [e for _, e, _ in rows(spark.read.parquet(str(tmp_path / "rejects")))] == ["no category rows in the document"]
    streamed(spark, tmp_path, stream_table)
    assert spark.table(stream_table).count() == 4


def test_winners_are_kept_by_the_stream(spark, tmp_path, stream_table):
    """Late, repeated and re-landed files, files without rows, and regions that no file of a batch changes."""
    landing = tmp_path / "landing"
    for day, region, text in ((2, "us", document("us2")), (1, "gb", document("gb1")), (9, "fr", json.dumps({"items": [{}]}))):
        put(landing / f"region={region}/date={day}/{region}_category_id.json", text)
    streamed(spark, tmp_path, stream_table, order="key")
    files = set(f.name for f in (tmp_path / "table").rglob("region=us/*.parquet"))
    put(landing / "region=us/date=1/us_category_id.json", document("us1"))
    put(landing / "region=gb/date=3/gb_category_id.json", '{"items": [{"id": "1", "id": "2", "snippet": {"title": "gb3"}, "n": NaN}]}')
    put(landing / "region=fr/date=1/fr_category_id.json", document("fr1"))
    streamed(spark, tmp_path, stream_table, order="key")
    found = spark.table(stream_table).select("region", "id", "snippet_title").collect()
    assert sorted(map(tuple, found)) == [("fr", "0", "fr1"), ("gb", "2", "gb3"), ("us", "0", "us2")]
    # Nothing that counts has landed for us: its partition has not been written again.
    assert set(f.name for f in (tmp_path / "table").rglob("region=us/*.parquet")) == files
    rejects = spark.read.parquet(str(tmp_path / "rejects")).select("_source_file", "error").collect()
    assert [(r[0].rsplit("/", 1)[1], r[1]) for r in rejects] == [("fr_category_id.json", "no category rows in the document")]


def test_key_order_equals_the_batch(spark, tmp_path, stream_table):
    landing = tmp_path / "landing"
    for day in (3, 1, 5, 2, 4):
        for region in ("us", "gb", "fr"):
            put(landing / f"region={region}/date={day}/{region}_category_id.json", document(f"{region}{day}", "x"))
    streamed(spark, tmp_path, stream_table, order="key", max_files_per_trigger=2)
    batch = silver_reference(read_category_json(spark, str(landing))).drop("_ingestion_timestamp")
    table = spark.table(stream_table).select(*batch.columns)
    assert table.count() == 6 and table.exceptAll(batch).isEmpty()
    put(landing / "region=us/date=0/us_category_id.json", document("late but older"))
    streamed(spark, tmp_path, stream_table, order="key")
    assert spark.table(stream_table).filter(F.col("snippet_title").contains("late")).isEmpty()
    assert spark.table(stream_table).count() == 6
