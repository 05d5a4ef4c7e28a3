"""Landings one after the other, against one run over all of them."""

import time

import pytest
from test_run import put, raw_line

from trendstrata.config import Settings
from trendstrata.plans.run import Places, Run
from trendstrata.schemas import RAW_COLUMNS

GOLD = ("trending_analytics", "channel_analytics", "category_analytics")


def csv(*lines):
    return "\n".join([",".join(RAW_COLUMNS), *lines]) + "\n"


@pytest.fixture
def runs(spark, tmp_path):
    """One that goes bit by bit, and one that starts over each time."""
    made = []
    for name in ("bit", "all"):
        settings = Settings(silver_db=f"silver_{name}_{tmp_path.name}", gold_db=f"gold_{name}_{tmp_path.name}")
        places = [str(tmp_path / "raw")] + [str(tmp_path / name / p) for p in ("reference", "silver", "gold", "ledger", "alerts")]
        made.append(Run(spark, Places(*places), settings, run_id=name))
        made[-1].prepare()
    yield made
    for run in made:
        for database in (run.settings.silver_db, run.settings.gold_db):
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def contents(spark, run):
    s = run.settings
    names = [f"{s.silver_db}.{t}" for t in (s.statistics_table, s.rejects_table)] + [f"{s.gold_db}.{t}" for t in GOLD]
    skip = {"_processed_at", "_aggregated_at"}
    found = []
    for name in names:
        df = spark.table(name)
        found.append(sorted(map(str, df.select(*sorted(c for c in df.columns if c not in skip)).collect())))
    return found


def both(spark, runs):
    bit, all_ = runs
    counts = bit.statistics_increment()
    written = bit.gold_increment()
    all_.statistics()
    all_.gold()
    assert contents(spark, bit) == contents(spark, all_)
    return counts, written


def test_three_landings(spark, tmp_path, runs):
    raw = tmp_path / "raw"
    for region in ("us", "gb", "fr"):
        put(raw / f"region={region}/1.csv", csv(*[raw_line(n, 1 + n % 3, 100 + n) for n in range(12)], "v1,24.01.01,short"))
    both(spark, runs)

    # Greater, lesser and new rows of one region, and a corrupt row; the others are not touched.
    partition = tmp_path / "bit/silver/statistics"
    untouched = sorted(p.name for p in partition.rglob("kind=good/region=fr/*.parquet"))
    stamps = spark.table(f"{runs[0].settings.silver_db}.clean_statistics").filter("video_id = 'v2' AND region = 'us'")
    stamp = stamps.first()["_processed_at"]
    put(raw / "region=us/2.csv", csv(raw_line(0, 1, 500), raw_line(1, 2, 5), raw_line(40, 5, 7), "v9,24.01.01,cut", "v9,24.01.01,cut"))
    counts, written = both(spark, runs)
    assert counts["files"] == 1 and counts["rows_read"] == 5 and counts["rows_corrupt"] == 2
    assert written["channel_analytics"] == 3  # those of the changed region alone
    assert sorted(p.name for p in partition.rglob("kind=good/region=fr/*.parquet")) == untouched
    held = spark.table(f"{runs[0].settings.silver_db}.clean_statistics").filter("video_id = 'v2' AND region = 'us'")
    assert held.first()["_processed_at"] == stamp

    # A new region, one more file, nothing, and the same again after a lost manifest entry.
    put(raw / "region=jp/1.csv", csv(raw_line(3, 1, 9)))
    put(raw / "region=gb/sub/2.csv", csv(raw_line(3, 1, 9000)))
    assert both(spark, runs)[0]["files"] == 2
    assert both(spark, runs) == ({"rows": 0, "files": 0}, {})


def test_repeated_changed_and_vanished_files(spark, tmp_path, runs):
    raw = tmp_path / "raw"
    for region in ("us", "gb"):
        for n in (1, 2):
            put(raw / f"region={region}/{n}.csv", csv(raw_line(n, n, 100 * n), raw_line(7, 1, 10 * n), "v,cut"))
    both(spark, runs)
    # The same rows land again under another name.
    put(raw / "region=us/3.csv", (raw / "region=us/1.csv").read_text())
    both(spark, runs)
    # A file changes: what it gave goes, also the greatest row of a key, and a day that only it had.
    time.sleep(0.01)
    put(raw / "region=us/2.csv", csv(raw_line(1, 1, 1)))
    both(spark, runs)
    assert spark.table(f"{runs[0].settings.silver_db}.clean_statistics").filter("views = 200 AND region = 'us'").isEmpty()
    # A file goes, then all files of a region.
    (raw / "region=us/1.csv").unlink()
    both(spark, runs)
    (raw / "region=gb/1.csv").unlink()
    (raw / "region=gb/2.csv").unlink()
    both(spark, runs)
    assert {r[0] for r in spark.table(f"{runs[0].settings.gold_db}.trending_analytics").select("region").collect()} == {"us"}


def test_a_failed_increment_is_made_up_for(spark, tmp_path, runs, monkeypatch):
    raw = tmp_path / "raw"
    put(raw / "region=us/1.csv", csv(raw_line(1, 1, 1), "v,cut"))
    both(spark, runs)
    put(raw / "region=us/2.csv", csv(raw_line(1, 1, 2), "v,cut,2"))
    with monkeypatch.context() as patched:
        patched.setattr(Run, "_remember", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            runs[0].statistics_increment()
    # The rows are there, the manifest is not: the file is read once more.
    assert both(spark, runs)[0]["files"] == 1


def test_one_scan_of_the_files_for_rows_and_rejects(spark, tmp_path, runs, monkeypatch):
    from oracle import plan

    from trendstrata.plans import run as module

    put(tmp_path / "raw/region=us/1.csv", csv(raw_line(1, 1, 1), "v,cut"))
    plans = []

    def write(df, *args, **kwargs):
        plans.append(plan(df))
        return module_write(df, *args, **kwargs)

    module_write = module.write_routed
    monkeypatch.setattr(module, "write_routed", write)
    counts = runs[0].statistics()
    assert (counts["rows"], counts["rejects"], counts["rows_read"], counts["rows_removed"]) == (1, 1, 2, 1)
    assert len(plans) == 1 and plans[0].split("\n\n")[0].count("Scan csv") == 1
