"""Raw statistics files and category documents."""

import json
from pathlib import Path

import pytest
from oracle import plan
from pyspark.sql import functions as F

from trendstrata.operators.categories import empty_documents, flatten_categories
from trendstrata.plans.reference import BY_ARRIVAL, reference_rows, silver_reference
from trendstrata.plans.silver import silver_statistics
from trendstrata.schemas import CORRUPT, RAW_COLUMNS
from trendstrata.session import kept
from trendstrata.sinks import one_file
from trendstrata.sources import read_category_json, read_raw_statistics, split_rejects
from trendstrata.sources.category_json import _read

HEADER = ",".join(RAW_COLUMNS)


def line(video="v1", views="10", description="text", title="t", **over):
    values = dict.fromkeys(RAW_COLUMNS, "") | {
        "video_id": video, "trending_date": "17.14.11", "title": title, "channel_title": "c", "category_id": "1",
        "views": views, "likes": "1", "dislikes": "1", "comment_count": "1", "description": description,
        "comments_disabled": "False", "ratings_disabled": "True", "video_error_or_removed": "x",
    } | over
    return ",".join(values[c] for c in RAW_COLUMNS)


def write(path: Path, *lines: str, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(("\n".join(lines) + "\n").encode(encoding))


def test_raw_statistics(spark, tmp_path, rows):
    write(tmp_path / "region=us/deep/er/a.csv", HEADER, line(), line("v2", description='"two\nlines, ""quoted"""'))
    write(tmp_path / "region=GB/b.csv", HEADER, line("v3"))
    write(tmp_path / "region=us/c.json", '{"not": "read"}')
    write(tmp_path / "loose.csv", HEADER, line("v4"))
    raw = read_raw_statistics(spark, str(tmp_path))
    assert raw.columns == [*RAW_COLUMNS, "region", CORRUPT, "_source_file"]
    assert set(dict(raw.dtypes).values()) == {"string"}
    assert rows(raw, "video_id", "region", "description", CORRUPT) == [
        ("v1", "us", "text", None), ("v2", "us", 'two\nlines, "quoted"', None), ("v3", "GB", "text", None),
        ("v4", "", "text", None),
    ]
    silver = silver_statistics(raw)
    assert rows(silver, "video_id", "region", "category_id", "ratings_disabled", "video_error_or_removed") == [
        ("v1", "us", 1, True, None), ("v2", "us", 1, True, None), ("v3", "gb", 1, True, None),
    ]


def test_encodings(spark, tmp_path):
    write(tmp_path / "latin/region=mx/a.csv", HEADER, line(title="Qué"), encoding="iso-8859-1")
    write(tmp_path / "utf/region=mx/a.csv", HEADER, line(title="Qué 日本"))
    assert read_raw_statistics(spark, str(tmp_path / "latin")).first()["title"] == "Qué"
    assert read_raw_statistics(spark, str(tmp_path / "utf"), encoding="UTF-8").first()["title"] == "Qué 日本"
    assert read_raw_statistics(spark, str(tmp_path / "utf")).first()["title"].startswith("QuÃ©")


def test_rejects(spark, tmp_path, rows):
    short, long = "v2,17.14.11,only three", line("v3") + ",surplus"
    write(tmp_path / "region=us/a.csv", HEADER, line(), short, long, line("v4"))
    raw = read_raw_statistics(spark, str(tmp_path))
    # By default broken rows stay: padded or cut.
    assert rows(raw, "video_id") == [("v1",), ("v2",), ("v3",), ("v4",)]
    good, rejects = split_rejects(raw)
    assert rows(good, "video_id") == [("v1",), ("v4",)]
    assert rows(rejects) == [("us", short), ("us", long)]
    assert (good.count(), rejects.count()) == (2, 2)
    assert good.groupBy("region").count().first()["count"] == 2


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for place in ("empty", "absent"):
        assert read_raw_statistics(spark, str(tmp_path / place)).count() == 0
        docs = read_category_json(spark, str(tmp_path / place))
        assert silver_reference(docs).count() == 0
        assert empty_documents(docs).count() == 0
    evolved = read_category_json(spark, str(tmp_path / "absent"))
    assert flatten_categories(evolved).count() == 0


def item(id, title="t", **over):
    return {"kind": "k", "etag": "e", "id": id, "snippet": {"title": title, "assignable": True, "channelId": "c"}} | over


def land(path: Path, document, indent=2):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(document if isinstance(document, str) else json.dumps(document, indent=indent, ensure_ascii=False))


@pytest.fixture
def documents(tmp_path):
    root = tmp_path / "reference"
    land(root / "region=us/date=2024-01-01/us_category_id.json", {"items": [item("1", "old"), item("2", "old")]})
    land(root / "region=us/date=2024-01-02/us_category_id.json",
         {"kind": "list", "items": [item("1", "first"), item("2", "zwei"), item("1", "last"), item(3, "número")]})
    land(root / "region=us/date=2024-01-03/us_category_id.json", {"items": []})
    land(root / "region=gb/date=2024-01-03/gb_category_id.json", '{"items": [{"id": ')
    land(root / "DE_category_id.json", {"kind": "whole", "etag": "w"})
    land(root / "region=fr/x.json", {"items": [{"kind": "n"}, {"kind": "n"}]})
    land(root / "region=fr/readme.txt", {"items": [item("1")]})
    return root


def test_repeated_names_and_odd_numbers(spark, tmp_path, rows):
    """What a VARIANT refuses is read as JSON parsers commonly do: the last value of a name counts."""
    land(tmp_path / "region=us/a.json", '{"etag": "x", "etag": "y", "items": [{"id": "1", "id": "2", "size": NaN, "snippet": {"title": "t"}}]}')
    land(tmp_path / "region=gb/lines.json", '{"items": [{"id": "3", "size": 7}]}\n{"items": [{"id": "4", "id": "5"}]}\n')
    land(tmp_path / "region=fr/bad.json", '{"id": "1", "id": "2"} and more')
    land(tmp_path / "region=de/half.json", '{"id": "\\ud800", "id": "2"}')
    docs = read_category_json(spark, str(tmp_path))
    flat = reference_rows(docs)
    assert rows(flat, "region", "id", "size") == [("de", "2", None), ("gb", "3", 7), ("gb", "5", None), ("us", "2", None)]
    assert [Path(f).parent.name for f, _ in rows(empty_documents(docs))] == ["region=fr"]


def test_fields_that_have_only_been_null_are_not_stored(spark, tmp_path):
    land(tmp_path / "region=us/a.json", {"items": [item("1", note=None, deep={"a": None, "b": [None]}, list=[{"c": None}])]})
    assert flatten_categories(read_category_json(spark, str(tmp_path))).columns[-6:] == [
        "kind", "etag", "id", "snippet_title", "snippet_assignable", "snippet_channelId",
    ]


def test_flatten(spark, documents, rows):
    docs = read_category_json(spark, str(documents))
    flat = flatten_categories(docs)
    assert flat.columns[-6:] == ["kind", "etag", "id", "snippet_title", "snippet_assignable", "snippet_channelId"]
    assert rows(flat, "id", "kind", "snippet_title") == [
        # A document without any id keeps all its items; a whole document is one row.
        (None, "n", None), (None, "n", None), (None, "whole", None),
        ("1", "k", "last"), ("1", "k", "old"), ("2", "k", "old"), ("2", "k", "zwei"), ("3", "k", "número"),
    ]
    assert [(Path(f).parent.parent.name, e) for f, e in rows(empty_documents(docs))] == [
        ("region=gb", "not a readable document"), ("region=us", "no category rows in the document"),
    ]


def test_silver_reference(spark, documents, rows):
    at = F.lit("2024-01-05 06:07:08").cast("timestamp")
    silver = silver_reference(read_category_json(spark, str(documents)).persist(), at=at)
    assert silver.columns == [
        "kind", "etag", "id", "snippet_title", "snippet_assignable", "snippet_channelId",
        "region", "_ingestion_timestamp", "_source_file",
    ]
    assert rows(silver, "region", "id", "snippet_title") == [
        ("de", None, None), ("fr", None, None), ("fr", None, None),
        ("us", "1", "last"), ("us", "2", "zwei"), ("us", "3", "número"),
    ]
    assert {r[0] for r in rows(silver, "_ingestion_timestamp")} == {"2024-01-05T06:07:08.000000+00:00"}


def test_ids_missing_in_part_count_as_one(spark, tmp_path, rows):
    land(tmp_path / "region=us/a.json", {"items": [item(None, "a"), {"snippet": {"title": "b"}}, item("1", "c")]})
    assert rows(flatten_categories(read_category_json(spark, str(tmp_path))), "id", "snippet_title") == [
        (None, "b"), ("1", "c"),
    ]


def test_one_named_file_and_several(spark, documents):
    named = documents / "region=us/date=2024-01-01/us_category_id.json"
    assert flatten_categories(read_category_json(spark, str(named))).count() == 2
    both = [str(named), str(documents / "DE_category_id.json")]
    assert flatten_categories(read_category_json(spark, both)).count() == 3


def test_order_by_arrival(spark, rows):
    docs = spark.createDataFrame(
        [("raw/region=us/b.json", "2024-01-01 00:00:00", 1), ("raw/region=us/a.json", "2024-01-02 00:00:00", 2)],
        "_source_file string, _modified_at string, _document long",
    ).withColumn("_modified_at", F.col("_modified_at").cast("timestamp"))
    snippet = "struct<title:string,assignable:boolean,channelId:string>"
    shaped = docs.withColumns({
        "kind": F.lit("d"), "etag": F.lit("e"), "id": F.col("_document").cast("string"),
        "snippet": F.lit(None).cast(snippet),
        "items": F.lit(None).cast(f"array<struct<kind:string,etag:string,id:string,snippet:{snippet}>>"),
    })
    assert rows(silver_reference(shaped), "id") == [("1",)]
    assert rows(silver_reference(shaped, BY_ARRIVAL), "id") == [("2",)]


def test_evolution(spark, tmp_path, rows):
    land(tmp_path / "region=us/a.json", {"items": [item("1", snippet={"title": "t", "color": "red"}, rank=5)]})
    land(tmp_path / "region=gb/b.json", {"items": [item("2")]})
    land(tmp_path / "region=fr/c.json", {"kind": "whole"})
    plain = reference_rows(read_category_json(spark, str(tmp_path), evolve=False))
    assert "rank" not in plain.columns
    evolved = reference_rows(read_category_json(spark, str(tmp_path)))
    assert rows(evolved, "region", "id", "rank", "snippet_color", "snippet_title") == [
        ("fr", None, None, None, None), ("gb", "2", None, None, "t"), ("us", "1", 5, "red", "t"),
    ]


def test_top_level_list_reads_as_documents(spark, tmp_path, rows):
    land(tmp_path / "region=us/a.json", [item("1", "x"), item("2", "y")])
    assert rows(flatten_categories(read_category_json(spark, str(tmp_path))), "id", "snippet_title") == [
        ("1", "x"), ("2", "y"),
    ]


@pytest.mark.parametrize("shape", ["document", "list", "line"])
def test_more_than_a_variant_holds(spark, tmp_path, rows, shape):
    items = [item(str(i), title="x" * (10 << 20), more=i) for i in range(14)]
    envelope = {"_pipeline_metadata": {"ingestion_timestamp": "2024-01-01T00:00:00"}}
    path = tmp_path / "region=us" / "a.json"
    if shape == "list":
        land(path, [{"items": items[:7], **envelope}, {"items": items[7:], **envelope}])
    elif shape == "document":
        land(path, {"items": items, **envelope})
    else:
        path.parent.mkdir(parents=True)
        path.write_text(json.dumps({"items": items, **envelope}) + "\n" + json.dumps({"items": [item("z")], **envelope}))
    assert path.stat().st_size > 128 << 20
    read = read_category_json(spark, str(tmp_path))
    found = read.select(F.col(CORRUPT).isNull().alias("whole"), "_landed_at", F.explode_outer("items").alias("i"))
    want = [(True, "2024-01-01T00:00:00", str(i), 10 << 20, i) for i in range(14)]
    got = rows(found.select("whole", "_landed_at", "i.id", F.length("i.snippet.title"), "i.more"))
    assert sorted(got, key=str) == sorted(want + ([(True, "2024-01-01T00:00:00", "z", 1, None)] if shape == "line" else []), key=str)


def test_texts_are_parsed_once_and_their_documents_read_after_that(spark, tmp_path):
    write(tmp_path / "us_category_id.json", '{"items": [{"id": "1"}]}', '{"items": [{"id": "2"}]}')
    write(tmp_path / "de_category_id.json", '{"items": [{"id": "3", "id": "4"}]}')
    rows = flatten_categories(read_category_json(spark, str(tmp_path)))
    steps = plan(rows).lower()
    assert "parsejson" not in steps and "parse_json" not in steps and "evalpython" not in steps
    assert sorted(r["id"] for r in rows.collect()) == ["1", "2", "4"]


def test_each_line_is_parsed_once(spark):
    texts = spark.createDataFrame([('{"a": 1}\n{"a": 2}',)], "value string").withColumn("_text", F.col("value"))
    listed = _read(texts).select("_listed")
    assert listed.selectExpr("size(_listed)").first()[0] == 2
    # The text and each line, both inside an array and inside an object.
    assert plan(listed).count("parseJson") == 4


def test_one_file_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(one_file, "PIECE", 100)
    rows = spark.range(1000, numPartitions=7).withColumn("text", F.concat(F.lit("ü\n"), "id"))
    file = one_file.write_one_file(rows, f"file://{tmp_path}/one")
    assert len(list((tmp_path / "one/parts").glob("*.json"))) == 7
    lines = Path(file.removeprefix("file://")).read_text().splitlines()
    assert sorted(json.loads(x)["id"] for x in lines) == list(range(1000))
    assert spark.read.json(file).exceptAll(rows.select("id", "text")).isEmpty()
    docs = read_category_json(spark, file, multi_line=False)
    assert flatten_categories(docs).count() == 1000


def test_only_refused_texts_are_read_again(spark, tmp_path):
    write(tmp_path / "us_category_id.json", '{"items": [{"id": "1"}]}')
    write(tmp_path / "de_category_id.json", '{"items": [{"id": "3", "id": "4"}]}')
    readings = []

    def keep(documents):
        readings.append(kept(documents, "reading"))
        return readings[-1]

    rows = flatten_categories(read_category_json(spark, str(tmp_path), keep=keep))
    # The second reading starts from what the first has stored: one text, and no document of the other.
    assert [r.count() for r in readings] == [2, 1]
    assert sorted(r["id"] for r in rows.collect()) == ["1", "4"]
