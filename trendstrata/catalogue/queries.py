"""Name to Spark query.  Each takes the session and the folder of the tables.

Dates come out as ISO text and arrays as joined text, so results compare the
same way whatever the client does with those types.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendstrata.config import Settings
from trendstrata.errors import SPARK_ERRORS
from trendstrata.functions import decode_key, flatten_struct, region_from_key, region_from_path
from trendstrata.operators import metrics, quality, serving
from trendstrata.operators.audit import landing_audit, missing_regions, present_regions
from trendstrata.operators.categories import (
    category_lookup,
    empty_documents,
    flatten_categories,
    name_categories,
)
from trendstrata.operators.cleanse import (
    add_ratios,
    drop_invalid,
    enforce_schema,
    normalise_region,
    parse_dates,
    zero_fill,
)
from trendstrata.operators.dedup import dedup_latest, latest_file_per_region
from trendstrata.plans import views
from trendstrata.plans.gold import GOLD_TABLES
from trendstrata.plans.reference import reference_rows, silver_reference
from trendstrata.plans.run import Places, Run
from trendstrata.plans.silver import (
    silver_statistics,
    stage_measures,
    tallied_statistics,
    typed_statistics,
)
from trendstrata.schemas import COUNTERS, SILVER_KEY
from trendstrata.session import fresh_folder, kept
from trendstrata.sinks.landing import land_raw, with_envelope
from trendstrata.sinks.ledger import append_alerts, append_ledger, ledger_per_file
from trendstrata.sinks.one_file import write_one_file
from trendstrata.sinks.tables import location, write_table
from trendstrata.sources.category_json import parse_documents, read_category_json
from trendstrata.sources.split_csv import read_split_statistics
from trendstrata.sources.statistics_csv import CSV_FORMAT, read_raw_statistics, split_rejects
from trendstrata.sources.tables import read_table
from trendstrata.streaming import drain_reference

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The moment the checks of the 2024 events look back from.
NOW = "2024-01-31 00:00:00"


def _now() -> Column:
    """``NOW`` in the session's zone, like the event times it is compared with."""
    return F.lit(NOW).cast("timestamp_ntz").cast("timestamp")


def _landed_at() -> Column:
    """``NOW`` in UTC, for values that are shown in UTC."""
    return F.lit(f"{NOW}+00:00").cast("timestamp")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _plain(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DateType):
        column = F.date_format(column, "yyyy-MM-dd")
    elif isinstance(field.dataType, T.TimestampType):
        column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    elif isinstance(field.dataType, T.ArrayType):
        column = F.array_join(column, "|")
    return column.alias(field.name)


def _shown(df: DataFrame, *columns: str) -> DataFrame:
    chosen = df.select(*columns) if columns else df
    return chosen.select(*[_plain(f) for f in chosen.schema.fields])


def _stamp_of_record() -> Column:
    return F.col("publish_time").cast("timestamp")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.event_statistics(spark, sf_dir)


def _event_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_statistics(_events(spark, sf_dir), "events", ["seq"], _stamp_of_record())


def _star_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_statistics(views.star_statistics(spark, sf_dir), "orders", views.STAR_ORDER)


def _silver_table(silver: DataFrame) -> DataFrame:
    """What the channel table reads, stored as a silver table is, since it reads them several times."""
    columns = ("video_id", "channel_title", "category_id", "views", "likes", "comment_count", "engagement_rate")
    return kept(silver.select(*columns, "region", "trending_date_parsed"), "silver")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.text_documents(spark, sf_dir)


def _taken_down(spark: SparkSession, *names: str) -> DataFrame:
    """The rows of the first table, from its files; the catalog's entries go."""
    rows = spark.read.schema(spark.table(names[0]).schema).parquet(location(spark, names[0]))
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    return rows


def _without_stamp(df: DataFrame) -> DataFrame:
    return _shown(df.drop("_aggregated_at"))


# --- statistics: raw to silver -------------------------------------------------


@query
def schema_enforcement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enforce_schema(_events(spark, sf_dir), ["seq"])


@query
def normalised_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_region(_events(spark, sf_dir)).select("seq", "region")


@query
def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(parse_dates(_events(spark, sf_dir)), "seq", "trending_date", "trending_date_parsed")


@query
def filled_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zero_fill(enforce_schema(_events(spark, sf_dir), ["seq"])).select("seq", *COUNTERS)


@query
def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = typed_statistics(_events(spark, sf_dir), ["seq"])
    return add_ratios(typed).select("seq", "like_ratio", "engagement_rate")


@query
def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_invalid(normalise_region(_events(spark, sf_dir))).select("seq", "video_id", "region")


@query
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = drop_invalid(typed_statistics(_events(spark, sf_dir), ["seq"]))
    return _shown(dedup_latest(typed, SILVER_KEY, ["seq"]), *SILVER_KEY, "seq")


@query
def event_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_event_silver(spark, sf_dir))


@query
def star_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = (*SILVER_KEY, "title", "channel_title", "category_id", *COUNTERS, "like_ratio", "engagement_rate")
    return _shown(_star_silver(spark, sf_dir), *columns, *views.STAR_ORDER)


@query
def stage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tallied_statistics(_events(spark, sf_dir), order=["seq"]).agg(*stage_measures())


@query
def silver_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.silver_warnings(_event_silver(spark, sf_dir))


# --- raw statistics files ------------------------------------------------------


def _write_csv(df: DataFrame, path: str) -> None:
    options = {**CSV_FORMAT, "quoteAll": "true", "encoding": "UTF-8"}
    spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode("append").partitionBy("region").options(**options, **spaces).csv(path)


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through CSV files in region folders into silver."""
    path = fresh_folder(spark, "csv")
    _write_csv(views.document_statistics(spark, sf_dir), path)
    return _described(silver_statistics(read_raw_statistics(spark, path, encoding="UTF-8")))


def _described(silver: DataFrame) -> DataFrame:
    described = silver.withColumn("description_md5", F.md5("description"))
    columns = (*SILVER_KEY, "title", "channel_title", "category_id", *COUNTERS, "ratings_disabled")
    return _shown(described, *columns, "like_ratio", "engagement_rate", "description_md5")


@query
def split_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the reader that takes a file in many tasks."""
    path = fresh_folder(spark, "csv")
    _write_csv(views.document_statistics(spark, sf_dir), path)
    return _described(silver_statistics(read_split_statistics(spark, path, encoding="UTF-8")))


def _write_broken_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Rows of which some lack and some add a column."""
    rows = views.document_statistics(spark, sf_dir)
    kind = F.col("views").cast("long") % 10
    _write_csv(rows.filter(~kind.isin(3, 7)), path)
    _write_csv(rows.filter(kind == 3).drop("description"), path)
    # The regions are the last column of what is written, and no column of the files.
    surplus = rows.filter(kind == 7).withColumn("surplus", F.lit("x"))
    _write_csv(surplus.select(*[c for c in surplus.columns if c != "region"], "region"), path)


@query
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and rejected rows per region, where rows lack or add a column."""
    path = fresh_folder(spark, "rejects")
    _write_broken_csv(spark, sf_dir, path)
    good, rejects = split_rejects(read_raw_statistics(spark, path, encoding="UTF-8"))
    counted = good.groupBy("region").agg(F.count("video_id").alias("good_rows"))
    rejected = rejects.groupBy("region").agg(F.count("_corrupt_record").alias("rejected_rows"))
    return counted.join(rejected, "region", "full").na.fill(0)


def _new_run(spark: SparkSession) -> Run:
    """A run with databases and folders of its own; its tables are external, so their files stay."""
    root = fresh_folder(spark, "run")
    database = "run_" + root.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    places = Places(*[f"{root}/{p}" for p in ("raw", "reference", "silver", "gold", "ledger", "alerts")])
    return Run(spark, places, Settings(silver_db=database, gold_db=database))


@contextmanager
def _own_run(spark: SparkSession) -> Iterator[Run]:
    run = _new_run(spark)
    try:
        yield run
    finally:
        spark.sql(f"DROP DATABASE {run.settings.silver_db} CASCADE")


def _files_of(run: Run, table: str) -> DataFrame:
    """A table's rows, also when its entry has gone."""
    name = f"{run.settings.silver_db}.{table}"
    return run.spark.read.schema(run.spark.table(name).schema).parquet(location(run.spark, name))


@query
def rejects_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of rows that a run sets apart while it writes the others."""
    with _own_run(spark) as run:
        _write_broken_csv(spark, sf_dir, run.places.raw_statistics)
        run.statistics(encoding="UTF-8")
        rejects = _files_of(run, run.settings.rejects_table)
    by_text = rejects.groupBy("region", F.md5("_corrupt_record").alias("text_md5"))
    return by_text.agg(F.sum("rows").alias("rows"))


@query
def run_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run counts of rows that it reads, sets apart, removes and writes."""
    with _own_run(spark) as run:
        _write_broken_csv(spark, sf_dir, run.places.raw_statistics)
        counts = run.statistics(encoding="UTF-8")
    names = ("rows_read", "rows_corrupt", "rows_clean", "rows_removed", "rows", "rejects")
    return spark.range(1).select(*[F.lit(counts[n]).cast("long").alias(n) for n in names])


def _three_landings(spark: SparkSession, sf_dir: str, run: Run) -> Iterator[None]:
    """All documents in three parts, one after the other; parts of a video come with different landings."""
    rows = views.document_statistics(spark, sf_dir)
    part = F.crc32("thumbnail_link") % 3
    for n in range(3):
        _write_csv(rows.filter(part == n), run.places.raw_statistics)
        run.statistics_increment(encoding="UTF-8")
        yield


@query
def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landings, each merged into what is there."""
    with _own_run(spark) as run:
        for _ in _three_landings(spark, sf_dir, run):
            pass
        silver = _files_of(run, run.settings.statistics_table)
    return _described(silver)


@query
def gold_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The channels after three landings, from sums of which only the changed days are made anew."""
    with _own_run(spark) as run:
        for _ in _three_landings(spark, sf_dir, run):
            run.gold_increment()
        channels = _files_of(run, "channel_analytics")
    return _without_stamp(channels)


@query
def region_leaves_the_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per region in all tables, after a region has gone from the feed."""
    with _own_run(spark) as run:
        rows = views.document_statistics(spark, sf_dir)
        for feed in ("before", "after"):
            run.places = replace(run.places, raw_statistics=f"{run.places.raw_statistics}/{feed}")
            _write_csv(rows if feed == "before" else rows.filter("region <> 'de'"), run.places.raw_statistics)
            run.statistics(encoding="UTF-8")
            run.gold()
        tables = (run.settings.statistics_table, *GOLD_TABLES)
        counts = [_files_of(run, t).groupBy(F.lit(t).alias("table"), "region").agg(F.count(F.lit(1)).alias("rows")) for t in tables]
    return reduce(DataFrame.unionByName, counts)


@query
def empty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No files, then statistics without rows, write nothing; the first files write all."""
    with _own_run(spark) as run:
        nothing = run.statistics(encoding="UTF-8")["rows"] + run.reference()["rows"]
        rows = views.document_statistics(spark, sf_dir)
        write_table(_described(silver_statistics(rows)).limit(0), run._silver(run.settings.statistics_table), f"{run.places.silver}/statistics")
        gold = len(run.gold())
        spark.sql(f"DROP TABLE {run._silver(run.settings.statistics_table)}")
        _write_csv(rows, run.places.raw_statistics)
        written = run.statistics(encoding="UTF-8")["rows"]
    found = {"rows_of_nothing": nothing, "gold_of_nothing": gold, "rows": written}
    return spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in found.items()])


@query
def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference, statistics, checks, gate and gold in one go; the categories carry the reference's names."""
    with _own_run(spark) as run:
        _write_csv(views.document_statistics(spark, sf_dir), run.places.raw_statistics)
        title = F.struct(F.col("n_name").alias("title")).alias("snippet")
        items = F.collect_list(F.struct(F.col("n_nationkey").cast("string").alias("id"), title)).alias("items")
        documents = views.table(spark, sf_dir, "nation").groupBy(F.concat(F.lit("r"), F.col("n_regionkey")).alias("region")).agg(items)
        land_raw(documents, run.places.raw_reference, "test tables")
        run.everything(encoding="UTF-8")
        categories = _files_of(run, "category_analytics")
    return _without_stamp(categories)


@query
def path_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = views.table(spark, sf_dir, "pages")
    path = F.concat_ws("/", F.lit("raw"), F.concat(F.lit("Region="), F.col("page_id") % 7), "url")
    return urls.select("page_id", region_from_path(path).alias("region"))


@query
def decoded_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys as an arrival notice spells them, back to plain text."""
    pages = views.table(spark, sf_dir, "pages")
    return pages.select("page_id", decode_key(F.url_encode(F.concat("url", F.lit(" a+b=ü%")))).alias("key"))


# --- category documents --------------------------------------------------------


@query
def reference_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_categories(_documents(spark, sf_dir))


@query
def reference_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return empty_documents(_documents(spark, sf_dir)).select("_source_file")


@query
def key_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return docs.select("_source_file", region_from_key(F.col("_source_file")).alias("region"))


@query
def flattened_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = views.table(spark, sf_dir, "conversations")
    nested = turns.select(
        "conv_id", "turn", F.struct("role", F.struct(F.length("text").alias("chars")).alias("text.size")).alias("said")
    )
    return flatten_struct(nested)


@query
def newest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reference_rows(_documents(spark, sf_dir))
    return latest_file_per_region(rows).select("region", "_source_file", "id", "snippet_title")


@query
def reference_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_reference(_documents(spark, sf_dir), at=_landed_at())


@query
def reference_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed as JSON in region folders and read back as categories."""
    path = fresh_folder(spark, "json")
    land_raw(_documents(spark, sf_dir).drop("_source_file", "_document"), path, "test tables")
    rows = reference_rows(read_category_json(spark, path))
    return rows.drop("_source_file", "_modified_at", "_ingestion_timestamp")


@query
def reference_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that only some documents' items have becomes a column."""
    path = fresh_folder(spark, "evolve")
    turns = views.table(spark, sf_dir, "conversations").withColumn("region", F.col("role"))
    item = {"id": F.col("turn").cast("string"), "kind": F.col("role")}
    plain = F.struct(*[c.alias(n) for n, c in item.items()], F.struct(F.col("text").alias("title")).alias("snippet"))
    extra = F.struct(
        *[c.alias(n) for n, c in item.items()],
        F.struct(F.col("text").alias("title"), F.col("conv_id").alias("thread")).alias("snippet"),
    )
    first = F.col("turn") == 0
    for part, shape in ((turns.filter(~first), plain), (turns.filter(first), extra)):
        part.select("region", F.array(shape).alias("items")).write.mode("append").partitionBy("region").json(path)
    rows = flatten_categories(read_category_json(spark, path))
    return rows.select("id", "kind", "snippet_title", "snippet_thread")


@query
def json_many_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of many documents, one per line: the default reader gives all of them."""
    path = fresh_folder(spark, "lines")
    docs = views.table(spark, sf_dir, "documents")
    item = F.struct(F.col("doc_id").cast("string").alias("id"), F.struct(F.col("text").alias("title")).alias("snippet"))
    landed = docs.select(F.col("lang").alias("region"), F.array(item).alias("items"))
    landed.write.partitionBy("region").option("maxRecordsPerFile", 1000).json(path)
    return reference_rows(read_category_json(spark, path)).select("region", "id", "snippet_title")


def _texts(spark: SparkSession, sf_dir: str, value: Column, chosen: str = "true") -> DataFrame:
    """One JSON text per document, as if read from a file named by its id."""
    docs = views.table(spark, sf_dir, "documents").filter(chosen)
    key = F.concat(F.lit("raw/"), "lang", F.lit("_category_id_"), "doc_id", F.lit(".json"))
    return docs.select(value.alias("value"), key.alias("_source_file"), F.lit(None).cast("timestamp").alias("_modified_at"))


@query
def json_trailing_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text after a document makes the file a reject; a second document does not."""
    one = F.to_json(F.struct(F.array(F.struct("source")).alias("items")))
    kind = F.col("doc_id") % 5
    value = F.when(kind == 0, F.concat(one, F.lit(" "), "lang")).when(kind == 1, F.concat(one, F.lit("]")))
    value = value.when(kind == 2, F.concat(one, F.lit("}"))).when(kind == 3, F.concat(one, F.lit("\n"), one)).otherwise(one)
    docs = parse_documents(_texts(spark, sf_dir, value))
    good = flatten_categories(docs).select("_source_file", "source", F.lit(None).cast("string").alias("error"))
    bad = empty_documents(docs).select("_source_file", F.lit(None).cast("string").alias("source"), "error")
    return good.unionByName(bad)


@query
def odd_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd leaves are NULL, an object in place of the list leaves a whole document, undeclared fields stay."""
    flag = F.when(F.col("doc_id") % 2 == 0, "neither").otherwise("true")
    item = F.struct(
        F.col("doc_id").alias("id"), F.col("n_chars").alias("size"),
        F.struct(F.col("text").alias("title"), flag.alias("assignable")).alias("snippet"),
    )
    listed = F.to_json(F.struct(F.array(item).alias("items")))
    whole = F.to_json(F.struct(F.col("source").alias("kind"), F.struct("lang").alias("items")))
    value = F.when(F.col("doc_id") % 3 == 0, whole).otherwise(listed)
    rows = flatten_categories(parse_documents(_texts(spark, sf_dir, value)))
    return rows.select("_source_file", "kind", "id", "size", "items_lang", "snippet_title", "snippet_assignable")


@query
def empty_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without any field give no rows and are named."""
    kind = F.col("doc_id") % 4
    value = F.when(kind == 0, "{}").when(kind == 1, '{"items": [{}]}').when(kind == 2, "").otherwise('{"kind": "k"}')
    return empty_documents(parse_documents(_texts(spark, sf_dir, value)))


@query
def relanded_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings on one day: the later one counts, whatever its files are called."""
    path = fresh_folder(spark, "relanded")
    counts = views.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    for label, at in (("old", "2024-01-30 10:00:00"), ("new", "2024-01-30 10:05:00")):
        title = F.struct(F.concat(F.lit(f"{label} "), "n").alias("title"))
        item = F.struct(F.col("c_nationkey").cast("string").alias("id"), title.alias("snippet"))
        docs = counts.select(F.concat(F.lit("r"), "c_nationkey").alias("region"), F.array(item).alias("items"))
        land_raw(docs, path, "test tables", F.lit(at).cast("timestamp"), keys=["region", "date"])
    return silver_reference(read_category_json(spark, path)).select("region", "id", "snippet_title")


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that repeat, at the top and in an item, and numbers that are none."""
    snippet = F.to_json(F.struct(F.col("text").alias("title")))
    item = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.col("n_chars").alias("size")))
    plain = F.concat(F.lit('{"items": ['), F.rtrim(item, F.lit("}")), F.lit(', "snippet": '), snippet, F.lit("}]}"))
    twice = F.concat(
        F.lit('{"etag": "a", "etag": "b", "items": [{"id": "first", "id": "'), "doc_id", F.lit('", "size": NaN, "snippet": '), snippet, F.lit("}]}")
    )
    value = F.when(F.col("doc_id") % 3 == 0, twice).otherwise(plain)
    rows = flatten_categories(parse_documents(_texts(spark, sf_dir, value)))
    return rows.select("_source_file", "id", "size", "snippet_title")


@query
def reference_type_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that is null, a whole number, a fraction and a text, batch by batch into one table."""
    path = fresh_folder(spark, "drift")
    name = "drift_" + path.rsplit("-", 1)[1]
    size = F.col("n_chars").cast("string")
    shapes = {
        "lang = 'en'": F.lit("null"),
        "lang = 'de'": size,
        "lang = 'fr'": F.concat(size, F.lit(".5")),
        "coalesce(lang, '') NOT IN ('en', 'de', 'fr')": F.concat(F.lit('"about '), size, F.lit('"')),
    }
    for chosen, shape in shapes.items():
        value = F.concat(F.lit('{"items": [{"id": "'), "doc_id", F.lit('", "size": '), shape, F.lit("}]}"))
        texts = _texts(spark, sf_dir, value, chosen)
        write_table(reference_rows(parse_documents(texts)).drop("_modified_at"), name, path)
    return _taken_down(spark, name).select("region", "id", "size")


@query
def one_named_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in one file, read by its name."""
    path = fresh_folder(spark, "named")
    docs = views.table(spark, sf_dir, "documents")
    item = F.struct(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("kind"), F.struct(F.col("text").alias("title")).alias("snippet"))
    file = write_one_file(docs.select(F.array(item).alias("items")), path)
    return flatten_categories(read_category_json(spark, file, multi_line=False)).select("id", "kind", "snippet_title")


@query
def stream_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landings drained one by one: late ones, one for some regions, and one that lands again on its day."""
    landed, path = fresh_folder(spark, "landed"), fresh_folder(spark, "streamed")
    name = "streamed_" + path.rsplit("-", 1)[1]
    places = [fresh_folder(spark, label) for label in ("progress", "stream-rejects")]
    counts = views.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    waves = (
        ("first", "2024-01-03 10:00:00", F.lit(True)),
        ("late", "2024-01-01 10:00:00", F.lit(True)),
        ("last", "2024-01-05 10:00:00", F.lit(True)),
        ("again", "2024-01-05 10:05:00", F.col("c_nationkey") % 2 == 0),
        ("late", "2024-01-04 10:00:00", F.lit(True)),
    )
    for label, at, which in waves:
        title = F.struct(F.concat(F.lit(f"{label} "), "n").alias("title")).alias("snippet")
        item = F.struct(F.col("c_nationkey").cast("string").alias("id"), title)
        docs = counts.filter(which).select(F.concat(F.lit("r"), "c_nationkey").alias("region"), F.array(item).alias("items"))
        land_raw(docs, landed, "test tables", F.lit(at).cast("timestamp"), keys=["region", "date"])
        drain_reference(spark, landed, name, path, *places, order="key")
    return _taken_down(spark, name).select("region", "id", "snippet_title")


# --- names, gold, serving ------------------------------------------------------


@query
def text_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_lookup(flatten_categories(_documents(spark, sf_dir)))


@query
def category_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = name_categories(_event_silver(spark, sf_dir), views.nation_lookup(spark, sf_dir))
    return named.select("seq", "category_id", "category_name")


@query
def category_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_categories(_event_silver(spark, sf_dir), None).select("seq", "category_name")


@query
def trending_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_stamp(metrics.trending_analytics(_event_silver(spark, sf_dir)))


@query
def channel_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = views.nation_lookup(spark, sf_dir)
    return _without_stamp(metrics.channel_analytics(_silver_table(_event_silver(spark, sf_dir)), lookup))


@query
def category_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = views.nation_lookup(spark, sf_dir)
    return _without_stamp(metrics.category_analytics(_event_silver(spark, sf_dir), lookup))


@query
def star_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_stamp(metrics.trending_analytics(_star_silver(spark, sf_dir)))


@query
def star_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = views.nation_lookup(spark, sf_dir)
    return _without_stamp(metrics.channel_analytics(_silver_table(_star_silver(spark, sf_dir)), lookup))


@query
def star_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = views.nation_lookup(spark, sf_dir)
    return _without_stamp(metrics.category_analytics(_star_silver(spark, sf_dir), lookup))


@query
def channel_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    channels = metrics.channel_summary(_star_silver(spark, sf_dir))
    return metrics.rank_channels(channels).select("region", "channel_title", "total_views", "rank_in_region")


@query
def customer_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order ranked by price inside its status, which are few large groups."""
    orders = views.table(spark, sf_dir, "orders")
    titled = orders.select(
        F.col("o_orderstatus").alias("region"),
        F.col("o_orderkey").cast("string").alias("channel_title"),
        F.floor("o_totalprice").alias("total_views"),
    )
    return metrics.rank_channels(titled)


@query
def view_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = _star_silver(spark, sf_dir)
    shares = metrics.day_share(metrics.category_summary(stats))
    return _shown(shares, "category_id", "region", "trending_date_parsed", "total_views", "view_share_pct")


@query
def top_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    trending = metrics.trending_analytics(_event_silver(spark, sf_dir))
    return _without_stamp(serving.top_days(trending, "click"))


@query
def top_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.top_channels(metrics.channel_summary(_star_silver(spark, sf_dir)))


@query
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = views.nation_lookup(spark, sf_dir)
    return serving.category_counts(metrics.category_summary(_event_silver(spark, sf_dir), lookup))


@query
def run_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files through the silver table into the gold table, without a reference table."""
    with _own_run(spark) as run:
        _write_csv(views.document_statistics(spark, sf_dir), run.places.raw_statistics)
        run.statistics(encoding="UTF-8")
        run.gold()
        channels = _files_of(run, "channel_analytics")
    return _without_stamp(channels)


@query
def aggregated_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time of aggregation beside the keys of a summary."""
    trending = metrics.trending_analytics(_event_silver(spark, sf_dir), _landed_at())
    return _shown(trending, "region", "trending_date_parsed", "_aggregated_at")


# --- data quality --------------------------------------------------------------


def _text_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.lit("2024-01-30T23:00:00.000000+00:00")
    return reference_rows(_documents(spark, sf_dir)).withColumn("_ingestion_timestamp", stamp)


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "clean_statistics": _event_silver(spark, sf_dir),
        "clean_reference_data": _text_reference(spark, sf_dir),
    }
    return quality.check_tables(tables, Settings(max_null_pct=4.0), _now())


@query
def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(
        _checked(spark, sf_dir),
        "check", "table", "column", "value", "threshold", "negative_count", "extreme_count", "missing_columns", "passed",
    )


@query
def dq_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summarise(_checked(spark, sf_dir))


@query
def dq_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "alerts")
    append_alerts(quality.alerts(_checked(spark, sf_dir)), path, "run")
    return spark.read.parquet(path).select("run_id", "check", "table", "column", "value")


@query
def dq_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check of the statistics fails: a column is gone, views leave their range, rows are few and old."""
    seq, views = F.col("seq") % 10, F.col("views")
    odd = F.when(seq == 0, -views - 1).when(seq == 1, views + Settings().max_views + 1).otherwise(views)
    broken = _event_silver(spark, sf_dir).withColumn("views", odd).drop("title")
    settings = Settings(max_null_pct=1.0, min_rows=1_000_000_000)
    results = quality.check_tables({"clean_statistics": broken}, settings, _now() + F.expr("INTERVAL 10 DAYS"))
    return _shown(results, "check", "column", "value", "negative_count", "extreme_count", "missing_columns", "passed")


@query
def star_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = quality.check_table(_star_silver(spark, sf_dir), "clean_statistics", Settings())
    return results.select("check", "table", "column", "value", "negative_count", "extreme_count", "passed")


@query
def gate_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold is built, since the checks of the statistics pass at 5 %."""
    stats = _event_silver(spark, sf_dir)
    results = quality.run_checks(spark, {"clean_statistics": lambda: stats}, Settings(), _now())
    return _without_stamp(quality.gate(results, lambda: metrics.trending_analytics(stats)))


@query
def gate_shut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold is not built at 1 %, nor when a table cannot be read; the reasons are."""
    stats = _event_silver(spark, sf_dir)
    tables = {"clean_statistics": lambda: stats, "absent": lambda: read_table(spark, "no_such_table_anywhere")}
    results = quality.run_checks(spark, tables, Settings(max_null_pct=1.0), _now())
    try:
        built = quality.gate(results, lambda: metrics.trending_analytics(stats))
    except quality.QualityGateError:
        return quality.alerts(results).select("check", "table", "column", "passed")
    raise AssertionError(f"the gate let {built} through")


# --- tables, landing, ledger ---------------------------------------------------


@query
def table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver through a catalog table in region partitions."""
    path = fresh_folder(spark, "table")
    name = "statistics_" + path.rsplit("-", 1)[1]
    write_table(_event_silver(spark, sf_dir).drop("_processed_at"), name, path)
    return _shown(_taken_down(spark, name), "seq", *SILVER_KEY, "views", "like_ratio")


@query
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writing one status again leaves the other partitions alone."""
    path = fresh_folder(spark, "overwrite")
    name = "orders_" + path.rsplit("-", 1)[1]
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    write_table(orders, name, path, keys=["o_orderstatus"])
    again = orders.filter("o_orderstatus = 'O'").withColumn("o_totalprice", -F.col("o_totalprice"))
    write_table(again, name, path, keys=["o_orderstatus"])
    return _taken_down(spark, name)


@query
def replace_survives_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replacement fails half way, and the rows that were there stay."""
    path = fresh_folder(spark, "replaced")
    name = "replaced_" + path.rsplit("-", 1)[1]
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    write_table(orders, name, path, keys=["o_orderstatus"], mode="replace")
    broken = F.when(F.col("o_orderstatus") == "P", F.raise_error(F.lit("lost")).cast("double")).otherwise(-F.col("o_totalprice"))
    try:
        write_table(orders.withColumn("o_totalprice", broken), name, path, keys=["o_orderstatus"], mode="replace")
    except SPARK_ERRORS:
        return _taken_down(spark, name)
    raise AssertionError("the replacement did not fail")


@query
def written_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count that comes back from a write, beside the count of the files."""
    path = fresh_folder(spark, "counted")
    line = views.table(spark, sf_dir, "lineitem")
    counts = write_table(line, path=path, keys=["l_returnflag", "l_linestatus"])
    stored = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_stored"))
    return stored.select(F.lit(counts["rows"]).cast("long").alias("rows_reported"), "rows_stored")


@query
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later batch brings one more column."""
    path = fresh_folder(spark, "evolved")
    name = "evolved_" + path.rsplit("-", 1)[1]
    orders = views.table(spark, sf_dir, "orders")
    done = F.col("o_orderstatus") == "F"
    write_table(orders.filter(done).select("o_orderkey", "o_orderstatus"), name, path, ["o_orderstatus"])
    wider = orders.filter(~done).select("o_orderkey", "o_orderpriority", "o_orderstatus")
    write_table(wider, name, path, ["o_orderstatus"])
    return _taken_down(spark, name).select("o_orderkey", "o_orderpriority", "o_orderstatus")


@query
def landing_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-time folder values and the item count of each document."""
    landed = with_envelope(_documents(spark, sf_dir), "test tables", _landed_at())
    meta = F.col("_pipeline_metadata")
    return landed.select(
        F.col("_document").alias("doc_id"), "region", "date", "hour",
        meta["ingestion_id"].alias("ingestion_id"), meta["video_count"].alias("video_count"),
        meta["source"].alias("source"),
    )


@query
def landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the landing folders hold, by partition."""
    path = fresh_folder(spark, "raw")
    land_raw(_documents(spark, sf_dir), path, "test tables", _landed_at())
    stored = spark.read.json(path)
    return stored.groupBy("region", F.col("date").cast("string").alias("date"), F.col("hour").cast("int").alias("hour")).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("_pipeline_metadata.video_count").alias("items"),
    )


def _landings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as expected regions, and users' events as what landed for them."""
    events = views.table(spark, sf_dir, "events")
    kind = F.when(F.col("value") > 100, "categories").otherwise("trending")
    landed = events.select(F.concat(F.lit(" R"), F.col("user_id")).alias("region"), kind.alias("kind"))
    customers = views.table(spark, sf_dir, "customer")
    return landed, customers.select(F.concat(F.lit("r"), F.col("c_custkey")).alias("region"))


@query
def landing_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_audit(*_landings(spark, sf_dir))


@query
def regions_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_regions(*_landings(spark, sf_dir))


@query
def regions_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present_regions(*_landings(spark, sf_dir))


@query
def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "ledger")
    docs = _documents(spark, sf_dir)
    append_ledger(ledger_per_file(reference_rows(docs), empty_documents(docs), "run", "reference", "silver"), path)
    return spark.read.parquet(path).select("run_id", "stage", "source", "region", "rows_written", "path", "error")
