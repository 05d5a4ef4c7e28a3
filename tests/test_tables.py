"""Tables, landed documents, ledger and the audit of landings."""

import pytest
from pyspark.sql import functions as F

from trendstrata.operators.audit import expected_regions, landing_audit, missing_regions, present_regions
from trendstrata.sinks import append_ledger, land_raw, ledger_row, write_table
from trendstrata.sinks.evolution import common_type
from trendstrata.sinks.landing import with_envelope
from trendstrata.sinks.tables import read_files
from trendstrata.sources import read_table, table_exists


def small(spark, *data, columns="x int, region string"):
    return spark.createDataFrame(list(data), columns)


@pytest.fixture
def named(spark, tmp_path):
    name = f"t_{tmp_path.name}".replace("-", "_")
    yield name, str(tmp_path / "table")
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_partitions_are_replaced_one_by_one(spark, named, rows):
    name, path = named
    assert not table_exists(spark, name)
    assert write_table(small(spark, (1, "us"), (2, "gb"), (3, "us")), name, path) == {"rows": 3}
    assert write_table(small(spark, (9, "us")), name, path) == {"rows": 1}
    assert rows(read_table(spark, name)) == [(2, "gb"), (9, "us")]
    assert write_table(small(spark, (7, "fr")), name, path, mode="append") == {"rows": 1}
    assert rows(read_table(spark, name)) == [(2, "gb"), (7, "fr"), (9, "us")]


def test_path_only(spark, tmp_path, rows):
    path = str(tmp_path / "files")
    write_table(small(spark, (1, "us"), (2, "gb")), path=path)
    write_table(small(spark, (9, "us", "n"), columns="x int, region string, y string"), path=path)
    assert rows(read_files(spark, path), "x", "y", "region") == [(2, None, "gb"), (9, "n", "us")]
    assert all(f.name.endswith(".snappy.parquet") for f in (tmp_path / "files").rglob("*.parquet"))


def test_columns_are_added(spark, named, rows):
    name, path = named
    write_table(small(spark, (1, "us")), name, path)
    wider = small(spark, ("gb", ["a"], 2), columns="region string, tags array<string>, x int")
    write_table(wider, name, path)
    write_table(small(spark, (3, "fr")), name, path)
    assert rows(read_table(spark, name), "x", "tags", "region") == [(1, None, "us"), (2, ["a"], "gb"), (3, None, "fr")]
    # The same array with another nullability is the same type.
    write_table(small(spark, (4, "jp")).withColumn("tags", F.array(F.lit("b"))), name, path)
    # A text among numbers makes the column text, also in the rows that were there.
    write_table(small(spark, ("z", "us"), columns="x string, region string"), name, path)
    assert rows(read_table(spark, name), "x", "tags", "region") == [
        ("2", ["a"], "gb"), ("3", None, "fr"), ("4", ["b"], "jp"), ("z", None, "us"),
    ]


def failing(df):
    return df.withColumn("x", F.when(F.col("x") > 0, F.raise_error(F.lit("lost"))).otherwise(F.col("x")))


def folders(path):
    return sorted(p.name for p in path.glob("v-*"))


def test_a_failed_replacement_leaves_the_rows(spark, named, tmp_path, rows):
    name, path = named
    with pytest.raises(Exception, match="lost"):
        write_table(failing(small(spark, (1, "us"))), name, path, mode="replace")
    assert not table_exists(spark, name) and folders(tmp_path / "table") == []
    assert write_table(small(spark, (1, "us"), (2, "gb")), name, path, mode="replace") == {"rows": 2}
    kept = folders(tmp_path / "table")
    with pytest.raises(Exception, match="lost"):
        write_table(failing(small(spark, (5, "us"), (0, "fr"))), name, path, mode="replace")
    assert rows(read_table(spark, name)) == [(1, "us"), (2, "gb")] and folders(tmp_path / "table") == kept


def test_replacing_moves_the_entry_and_keeps_one_version_more(spark, named, tmp_path, rows):
    name, path = named
    for n in range(4):
        write_table(small(spark, (n, "us"), (n, f"r{n}")), name, path, mode="replace")
        assert rows(read_table(spark, name)) == [(n, f"r{n}"), (n, "us")]
    assert len(folders(tmp_path / "table")) == 2
    # A reader that began on the version before can finish.
    before = read_table(spark, name)
    write_table(small(spark, (9, "us")), name, path, mode="replace")
    assert before.count() == 2
    # Partitions of the current version are replaced and added in place.
    write_table(small(spark, (8, "gb")), name, path)
    write_table(small(spark, (7, "gb")), name, path, mode="append")
    assert rows(read_table(spark, name)) == [(7, "gb"), (8, "gb"), (9, "us")]
    pruned = read_table(spark, name).filter("region = 'us'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in pruned
    # New columns come with the version, columns that it lacks stay.
    write_table(small(spark, ("a", "us"), columns="y string, region string"), name, path, mode="replace")
    assert rows(read_table(spark, name), "x", "y", "region") == [(None, "a", "us")]
    write_table(small(spark, (1, "us")).limit(0), name, path, mode="replace")
    assert read_table(spark, name).count() == 0


def test_a_table_with_partitions_in_the_catalog_can_be_replaced(spark, named, rows):
    name, path = named
    write_table(small(spark, (1, "us"), (2, "gb")), name, path)
    write_table(small(spark, (3, "fr")), name, path, mode="replace")
    assert rows(read_table(spark, name)) == [(3, "fr")]
    with pytest.raises(ValueError, match="a name and a path"):
        write_table(small(spark, (1, "us")), name, mode="replace")


@pytest.mark.parametrize(
    ("have", "new", "want"),
    [
        ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("bigint", "decimal(5,2)", "decimal(22,2)"),
        ("decimal(38,0)", "decimal(38,10)", "double"), ("double", "string", "string"), ("boolean", "bigint", "string"),
        ("date", "timestamp", "timestamp"), ("void", "int", "int"), ("array<int>", "array<double>", "array<double>"),
        ("struct<a:int,b:string>", "struct<B:int,c:array<void>>", "struct<a:int,b:string,c:array<void>>"),
        ("struct<a:int>", "bigint", "string"), ("map<string,int>", "map<string,double>", "map<string,double>"),
    ],
)
def test_least_common_types(spark, have, new, want):
    both = [spark.createDataFrame([], f"x {kind}").schema["x"].dataType for kind in (have, new)]
    assert common_type(*both).simpleString() == want
    assert common_type(both[1], both[0]).simpleString().lower() in (want, want.replace("b:string", "b:string").lower(), "struct<b:string,c:array<void>,a:int>")


def test_nested_types_drift(spark, named, rows):
    name, path = named
    first = small(spark, (1, "us", (1, None, [1])), columns="x int, region string, s struct<a: int, n: void, l: array<int>>")
    write_table(first, name, path)
    assert "n" not in read_table(spark, name).schema["s"].dataType.names  # nothing is known of it yet
    second = small(spark, (2, "gb", (2.5, 7, ["k"])), columns="x int, region string, s struct<a: double, n: bigint, l: array<string>>")
    write_table(second, name, path)
    third = small(spark, (3, "fr", "all text"), columns="x int, region string, s string")
    assert [tuple(r) for r in read_table(spark, name).orderBy("x").select("x", "s.a", "s.n", "s.l", "region").collect()] == [
        (1, 1.0, None, ["1"], "us"), (2, 2.5, 7, ["k"], "gb"),
    ]
    write_table(third, name, path, mode="append")
    assert rows(read_table(spark, name), "x", "s") == [
        (1, '{"a":1.0,"l":["1"]}'), (2, '{"a":2.5,"l":["k"],"n":7}'), (3, "all text"),
    ]


def test_empty_result(spark, named):
    name, path = named
    assert write_table(small(spark, (1, "us")).limit(0), name, path) == {"rows": 0}
    assert read_table(spark, name).count() == 0
    write_table(small(spark, (1, "us")), name, path)
    assert write_table(small(spark, (1, "us")).filter("x > 5"), name, path) == {"rows": 0}
    assert read_table(spark, name).count() == 1


def test_counts_on_the_way(spark, tmp_path):
    counts = write_table(small(spark, (1, "us"), (5, "us")), path=str(tmp_path / "m"), measures=[F.sum("x").alias("total")])
    assert counts == {"rows": 2, "total": 6}


def test_arguments(spark, tmp_path):
    with pytest.raises(ValueError, match="mode"):
        write_table(small(spark, (1, "us")), path=str(tmp_path), mode="upsert")
    with pytest.raises(ValueError, match="name or a path"):
        write_table(small(spark, (1, "us")))


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """Nine rows of ten belong to one region; balancing splits them by size."""
    df = spark.range(0, 200_000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 512).alias("x"), F.when(F.col("id") % 10 == 0, "us").otherwise("gb").alias("region")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        write_table(df, path=str(tmp_path / "hot"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "hot/region=gb").glob("*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 200_000


AT = "2026-06-07 14:15:30"


def test_landing(spark, tmp_path, rows):
    docs = small(spark, (" US ", [1, 2]), ("gb", None), ("us", []), columns="region string, items array<int>")
    at = F.lit(AT).cast("timestamp")
    assert land_raw(docs, str(tmp_path / "raw"), "feed", at) == 3
    assert sorted(str(p.relative_to(tmp_path / "raw")) for p in (tmp_path / "raw").glob("*/*/*")) == [
        "region=gb/date=2026-06-07/hour=14", "region=us/date=2026-06-07/hour=14",
    ]
    meta = spark.read.json(str(tmp_path / "raw")).select("_pipeline_metadata.*")
    assert rows(meta, "region", "video_count", "ingestion_id", "ingestion_timestamp", "source") == [
        ("gb", 0, "20260607_141530", "2026-06-07T14:15:30.000000+00:00", "feed"),
        ("us", 0, "20260607_141530", "2026-06-07T14:15:30.000000+00:00", "feed"),
        ("us", 2, "20260607_141530", "2026-06-07T14:15:30.000000+00:00", "feed"),
    ]


def test_landing_of_categories(spark, tmp_path):
    docs = small(spark, ("us", 1), columns="region string, x int")
    land_raw(docs, str(tmp_path), "feed", F.lit(AT).cast("timestamp"), keys=["region", "date"], counted_as=None)
    assert [p.name for p in (tmp_path / "region=us").iterdir()] == ["date=2026-06-07"]
    enveloped = with_envelope(docs, "feed", counted_as=None)
    assert enveloped.select("_pipeline_metadata.*").columns == ["ingestion_id", "region", "ingestion_timestamp", "source"]
    assert with_envelope(docs, "feed").select("_pipeline_metadata.video_count").first()[0] == 0


def test_landing_audit(spark, rows):
    landed = small(spark, ("us", "trending"), ("US ", "categories"), ("gb", "trending"), ("fr", "categories"), ("zz", "trending"),
                   columns="region string, kind string")
    expected = expected_regions(spark, ["US", "gb ", "fr", "jp"])
    assert rows(landing_audit(landed, expected)) == [
        ("fr", "failed", "trending"), ("gb", "failed", "categories"), ("jp", "failed", "trending"), ("us", "success", None),
    ]
    assert rows(missing_regions(landed, expected)) == [("jp",)]
    assert rows(present_regions(landed, expected)) == [("fr",), ("gb",), ("us",)]


def test_ledger(spark, tmp_path, rows):
    path = str(tmp_path / "ledger")
    append_ledger(ledger_row(spark, "r1", "gold", "t", 5, "p"), path)
    append_ledger(ledger_row(spark, "r1", "gold", "u", error="broken"), path)
    stored = spark.read.parquet(path)
    assert rows(stored.drop("recorded_at")) == [
        ("r1", "gold", "t", None, 5, "p", None), ("r1", "gold", "u", None, None, None, "broken"),
    ]
