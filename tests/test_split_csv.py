"""Files with quoted line breaks in many tasks, against the reader that takes a file at a time."""

import random

import pytest
from pyspark.sql import functions as F

from trendstrata.schemas import CORRUPT, RAW_COLUMNS
from trendstrata.sources import read_raw_statistics
from trendstrata.sources import split_csv
from trendstrata.sources.split_csv import read_split_statistics

HEADER = ",".join(RAW_COLUMNS)


@pytest.fixture
def small_ranges(spark):
    """Ranges of two thousand bytes, so that records reach over their borders."""
    changed = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "100"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def field(r):
    kind, text = r.randrange(6), "".join(r.choice('abc é,"\n') for _ in range(r.randrange(12)))
    if kind == 0:
        text = "x" * r.randrange(200) + "\n" * r.randrange(5) + text
    if kind == 1:
        return ""
    if kind == 2:
        return "".join(c for c in text if c not in '",\n')
    return '"' + text.replace('"', '""') + '"'


def records(r, n):
    out = [HEADER]
    for i in range(n):
        row = [field(r) for _ in RAW_COLUMNS]
        row = row[:5] if i % 17 == 3 else [*row, "more"] if i % 17 == 5 else row
        if i % 17 == 7:
            row[-1] = '"' + "long\n" * 900 + '"'  # over several ranges
        out += [",".join(row)] + [""] * (i % 13 == 0)
    return out


def put(path, text, encoding="latin-1"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


def same(spark, path, encoding="ISO-8859-1"):
    one = sorted(map(str, read_raw_statistics(spark, str(path), encoding).collect()))
    assert sorted(map(str, read_split_statistics(spark, str(path), encoding).collect())) == one
    return one


def one_task_files(monkeypatch):
    taken = []

    def reader(spark, path, *args, **options):
        taken.extend(path)
        return read_raw_statistics(spark, path, *args, **options)

    monkeypatch.setattr(split_csv, "read_raw_statistics", reader)
    return taken


def test_regular_files_are_read_in_many_tasks(spark, tmp_path, small_ranges, monkeypatch):
    r = random.Random(1)
    for name, end, last in (("us", "\n", "\n"), ("gb", "\r\n", "\r\n"), ("fr", "\n", "")):
        put(tmp_path / f"Region={name}/a b+c.csv", end.join(records(r, 40)) + last)
    put(tmp_path / "region=de/head.csv", HEADER + "\n")
    put(tmp_path / "region=de/none.csv", "")
    put(tmp_path / "other.txt", "no\n")
    taken = one_task_files(monkeypatch)
    rows = same(spark, tmp_path)
    assert taken == [] and len(rows) == 120 and sum(f"{CORRUPT}=None" not in row for row in rows) > 10
    assert read_split_statistics(spark, str(tmp_path)).select("region").distinct().count() == 3


def test_irregular_files_are_read_in_one_task(spark, tmp_path, small_ranges, monkeypatch):
    r = random.Random(2)
    put(tmp_path / "region=us/good.csv", "\n".join(records(r, 20)) + "\n")
    stray = records(r, 20)
    stray[3] = 'a 5" disk,b,5" more' + "," * 13
    put(tmp_path / "region=gb/stray.csv", "\n".join(stray) + "\n")
    put(tmp_path / "region=fr/open.csv", "\n".join(records(r, 5)) + '\n"open,\nto the end')
    taken = one_task_files(monkeypatch)
    same(spark, tmp_path)
    assert sorted(p.rsplit("/", 1)[1] for p in taken) == ["open.csv", "stray.csv"]


def test_other_encodings(spark, tmp_path, small_ranges):
    put(tmp_path / "region=us/a.csv", "\n".join(records(random.Random(3), 20)) + "\n", "utf-8")
    same(spark, tmp_path, "UTF-8")
    with pytest.raises(ValueError, match="encoding must be one of"):
        read_split_statistics(spark, str(tmp_path), "UTF-16")


def test_no_files(spark, tmp_path):
    assert read_split_statistics(spark, str(tmp_path / "absent")).count() == 0


def test_a_changed_range_is_an_error(spark, tmp_path, small_ranges):
    put(tmp_path / "region=us/a.csv", "\n".join(records(random.Random(4), 40)) + "\n")
    rows = read_split_statistics(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    with pytest.raises(Exception, match="ranges of the files have changed"):
        rows.select(F.max("views")).collect()
