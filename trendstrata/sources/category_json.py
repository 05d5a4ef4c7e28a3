"""Category documents: JSON files, read in batch or as they arrive."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendstrata.functions import decode_path
from trendstrata.schemas import CATEGORY_ITEM, CORRUPT, ENVELOPE, UNREADABLE, WITHOUT_ROWS
from trendstrata.session import kept
from trendstrata.sources.missing import read_or

# What Spark prints for a VARIANT's objects, apart from quoted names.
_OBJECT = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<")


def _options(files: str) -> dict[str, str]:
    return {"recursiveFileLookup": "true", "pathGlobFilter": files}


def _with_lineage(texts: DataFrame) -> DataFrame:
    return texts.select(
        "value",
        decode_path(F.col("_metadata.file_path")).alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_modified_at"),
    )


_LINEAGE = ("_source_file", "_modified_at")

# Names that the tables use themselves.
_TAKEN = frozenset(
    {"_source_file", "_modified_at", "_document", "_landed_at", "_pipeline_metadata", "_ingestion_timestamp", "region", CORRUPT}
)


def _additive(declared: T.DataType, found: T.DataType) -> T.DataType:
    """``declared`` plus the fields only ``found`` has; declared types win.

    Of names that differ by letter case alone, one is kept.
    """
    if isinstance(declared, T.StructType) and isinstance(found, T.StructType):
        known = {f.name: f for f in found.fields}
        kept = [
            T.StructField(f.name, _additive(f.dataType, known[f.name].dataType) if f.name in known else f.dataType)
            for f in declared.fields
        ]
        seen = {f.name.lower() for f in kept}
        for field in found.fields:
            if field.name.lower() not in seen:
                seen.add(field.name.lower())
                kept.append(T.StructField(field.name, _additive(T.StructType(), field.dataType) if isinstance(field.dataType, T.StructType) else field.dataType))
        return T.StructType(kept)
    return declared


def _storable(found: T.DataType) -> T.DataType | None:
    """A found type as a column type: mixed fields are text, fractions are doubles; what has only been NULL has none."""
    if isinstance(found, T.StructType):
        fields = [(f.name, _storable(f.dataType)) for f in found.fields]
        kept = [T.StructField(name, kind) for name, kind in fields if kind is not None]
        return T.StructType(kept) if kept else None
    if isinstance(found, T.ArrayType):
        element = _storable(found.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(found, T.NullType):
        return None
    if isinstance(found, T.VariantType):
        return T.StringType()
    return T.DoubleType() if isinstance(found, (T.DecimalType, T.FloatType)) else found


def _variant(column: str, shape: str, path: str = "$") -> Column:
    return F.expr(f"try_variant_get({column}, '{path}', '{shape}')")


def _one_document(text: Column) -> Column:
    """The text as a VARIANT if it is one JSON value and nothing else, or NULL.

    The parser stops at the end of a value.  Inside an array and inside an
    object it goes on, and only nothing at all can follow a value in both.
    """
    in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"d":'), text, F.lit("}")))
    return F.when(in_array.isNotNull(), F.try_variant_get(in_object, "$.d", "variant"))


# Texts above this many bytes may be more than a VARIANT holds, 128 MiB with the offsets that it adds.
LARGE = 1 << 24
_HEAD = "struct<items: array<variant>, _pipeline_metadata: variant>"
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "maxStringLen": str((1 << 31) - 1)}


def _in_parts(text: Column, shape: str) -> Column:
    """A large text as ``shape``, with VARIANTs only inside it, if it is one JSON value of that kind and nothing else, or NULL."""
    in_array = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{shape}>", _STRICT)
    in_object = F.from_json(F.concat(F.lit('{"d":'), text, F.lit("}")), f"struct<d: {shape}>", _STRICT)
    return F.when((F.octet_length(text) > LARGE) & in_array.isNotNull(), in_object["d"])


def _entry(variant: Column | None = None, head: Column | None = None) -> Column:
    """A document as a VARIANT, or a larger one's items and envelope."""
    variant = F.lit(None).cast("variant") if variant is None else variant
    return F.struct(variant.alias("d"), (F.lit(None).cast(_HEAD) if head is None else head).alias("head"))


def _each_line(text: Column) -> Column:
    """Each line as a document.  What a line is parsed to is kept beside it, since an expression used twice in a lambda is evaluated twice."""
    lines = F.filter(F.split(text, "[\r\n]+"), lambda line: F.trim(line) != "")
    parsed = F.transform(lines, lambda line: F.struct(line.alias("text"), _one_document(line).alias("one")))
    return F.transform(parsed, lambda p: _entry(p["one"], F.when(p["one"].isNull(), _in_parts(p["text"], _HEAD))))


def _plain_json(text: str | None) -> str | None:
    """A text, or each of its lines, as JSON without repeated names and odd numbers, or None if it is not JSON.

    Of a repeated name the last value counts; ``NaN`` and the infinities are null.
    """
    if text is None:
        return None

    def plain(part: str) -> str:
        return json.dumps(json.loads(part, parse_constant=lambda _: None), ensure_ascii=False)

    lines = [line for line in re.split("[\r\n]+", text) if line.strip()]
    for parts in ([text], lines):
        try:
            found = "\n".join(plain(part) for part in parts)
            found.encode()  # half a surrogate pair is no text
            return found
        except (ValueError, RecursionError):
            continue
    return None


@F.pandas_udf(T.StringType())
def _second_reading(texts: pd.Series) -> pd.Series:
    """For the few texts that a VARIANT refuses."""
    return texts.map(_plain_json, na_action="ignore")


def _read(texts: DataFrame) -> DataFrame:
    """``_listed``, the documents of ``_text`` (itself, the entries of a list, or one for each line), and whether all of it is such."""
    text, one = F.col("_text"), F.col("_one")
    head = _in_parts(text, _HEAD)
    listed = F.coalesce(
        F.transform(_variant("_one", "array<variant>"), lambda d: _entry(d)),
        F.when(one.isNotNull(), F.array(_entry(one))),
        F.transform(_in_parts(text, "array<variant>"), lambda d: _entry(d)),
        F.transform(_in_parts(text, f"array<{_HEAD}>"), lambda h: _entry(head=h)),
        F.when(head.isNotNull(), F.array(_entry(head=head))),
        _each_line(text),
    )
    objects = F.forall("_listed", lambda e: F.try_variant_get(e["d"], "$", "map<string,variant>").isNotNull() | e["head"]["items"].isNotNull())
    split = texts.withColumn("_one", _one_document(text)).withColumn("_listed", listed)
    return split.withColumn("_ok", F.coalesce(objects & (F.size("_listed") > 0), F.lit(False)))


def _first_reading(texts: DataFrame, again: bool = True) -> DataFrame:
    """One row per document: ``_entries``, envelope, lineage, and the text of what cannot be read.

    A text is one document, a list of documents, or one document per line; a
    text with anything else in it is a single reject.  Where the text is more
    than one VARIANT holds, its documents, or their items, are VARIANTs each.
    ``_entries`` are the items, or the document itself where it has no list of them.
    With ``again`` a text of up to ``LARGE`` bytes that a VARIANT refuses is in ``_again`` instead.

    A generator that drops nothing hands the documents on: no later filter moves below it, so each text is parsed once.
    """
    read = _read(texts)
    each = F.when(F.col("_ok"), F.col("_listed")).otherwise(F.array(_entry()))
    refused = F.when(~F.col("_ok"), F.col("value"))
    once_more = refused.isNotNull() & (F.octet_length("value") <= LARGE) if again else F.lit(False)
    exploded = read.withColumns({CORRUPT: F.when(~once_more, refused), "_again": F.when(once_more, refused)}).select(
        *_LINEAGE, CORRUPT, "_again", F.explode_outer(each).alias("_e")
    )
    exploded = exploded.select(*_LINEAGE, CORRUPT, "_again", F.col("_e.d").alias("_d"), F.col("_e.head").alias("_head"))
    items = F.coalesce(_variant("_d", "array<variant>", "$.items"), F.col("_head.items"))
    envelope = ENVELOPE.simpleString()
    return exploded.withColumn("_items", items).select(
        *_LINEAGE, CORRUPT, "_again",
        F.coalesce("_items", F.when(F.col("_d").isNotNull(), F.array("_d"))).alias("_entries"),
        F.coalesce(
            _variant("_d", envelope, "$._pipeline_metadata"), _variant("_head._pipeline_metadata", envelope)
        ).alias("_pipeline_metadata"),
    )


Keep = Callable[[DataFrame], DataFrame]


def _documents(texts: DataFrame, keep: Keep | None = None) -> DataFrame:
    """``_first_reading``, and a second one of the texts that a VARIANT refuses, since a name is repeated in them or a number is none.

    ``keep`` may store either, so that neither is done twice.
    """
    plain = texts.filter(F.col("value").isNotNull()).withColumn("value", F.regexp_replace("value", r"^\uFEFF", ""))
    plain = plain.withColumn("_text", F.col("value"))
    first = _first_reading(plain) if keep is None else keep(_first_reading(plain))
    # Apart from the others, so that only these pass through Python.
    refused = first.filter(F.col("_again").isNotNull()).select(*_LINEAGE, F.col("_again").alias("value"))
    good = first.filter(F.col("_again").isNull())
    if keep is not None and refused.isEmpty():
        return good
    second = _first_reading(refused.withColumn("_text", _second_reading("value")), again=False)
    return good.unionAll(second if keep is None else keep(second))


def _landed_at() -> Column:
    return F.coalesce(F.col("_pipeline_metadata.ingestion_timestamp"), F.lit("")).alias("_landed_at")


# A value of some type in what `schema_of_variant` prints, apart from quoted names.
_QUOTED_NAME = "`(?:[^`]|``)*`"
_TYPED = ": (?!VOID|OBJECT)[A-Z]"


def document_heads(texts: DataFrame) -> DataFrame:
    """One short row per document: lineage, ``_landed_at``, and why it gives no rows (NULL if it does).

    No pass over the texts to find fields: a document gives rows if any of its items has a value.
    """
    kind = F.transform("_entries", lambda entry: F.regexp_replace(F.schema_of_variant(entry), _QUOTED_NAME, ""))
    documents = _documents(texts).withColumn("_kinds", kind)
    found = F.coalesce(F.exists("_kinds", lambda k: F.regexp_like(k, F.lit(_TYPED))), F.lit(False))
    error = F.when(F.col(CORRUPT).isNotNull(), F.lit(UNREADABLE)).when(~found, F.lit(WITHOUT_ROWS))
    return documents.select("_source_file", "_modified_at", _landed_at(), error.alias("error"))


def _found_fields(documents: DataFrame) -> T.StructType:
    """Fields of all items and of all documents without a list of them, in one pass."""
    entries = documents.select(
        F.explode("_entries").alias("_entry")
    ).filter(_variant("_entry", "map<string,variant>").isNotNull())
    ddl = entries.agg(F.expr("schema_of_variant_agg(_entry)").alias("ddl")).first()["ddl"]
    ddl = _OBJECT.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], ddl)
    found = documents.sparkSession.createDataFrame([], f"found {ddl}").schema["found"].dataType
    found = _storable(found) if isinstance(found, T.StructType) else None
    fields = found.fields if isinstance(found, T.StructType) else []
    return T.StructType([f for f in fields if f.name.lower() not in _TAKEN])


def _stored(documents: DataFrame) -> DataFrame:
    return kept(documents, "parsed")


def parse_documents(texts: DataFrame, evolve: bool = True, keep: Keep | None = None) -> DataFrame:
    """Category documents of the texts ``value`` with ``_source_file`` and ``_modified_at``.

    ``items`` holds the items, or the document itself where it has no list of
    them; it is NULL, and the corrupt column holds the text, where the text is
    not JSON through and through.  A value that does not fit its field is NULL.
    ``evolve`` adds the fields found in the texts to the declared ones, at the
    price of one more pass; without it they are left out.  The parsed documents are stored for
    that pass, by ``keep`` or in a folder of their own, so that none parses the texts again.
    """
    documents = _documents(texts, keep or (_stored if evolve else None))
    item = _additive(CATEGORY_ITEM, _found_fields(documents)) if evolve else CATEGORY_ITEM
    ddl = _ddl(item).replace("'", "\\'")
    typed = F.expr(f"transform(_entries, entry -> try_variant_get(entry, '$', '{ddl}'))")
    return documents.select(
        typed.alias("items"), "_pipeline_metadata", CORRUPT, "_source_file", "_modified_at", _landed_at()
    ).withColumn("_document", F.monotonically_increasing_id())


def _ddl(found: T.DataType) -> str:
    if isinstance(found, T.StructType):
        fields = [f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in found.fields]
        return f"struct<{', '.join(fields)}>"
    return f"array<{_ddl(found.elementType)}>" if isinstance(found, T.ArrayType) else found.simpleString()


def read_category_json(
    spark: SparkSession,
    path: str | Sequence[str],
    multi_line: bool = True,
    files: str = "*.json",
    evolve: bool = True,
    keep: Keep | None = None,
) -> DataFrame:
    """One row per document under ``path``: a folder of any depth, one file, or several.

    A file is read as a whole, by one task: it holds one document, however
    printed, or one per line.  ``multi_line=False`` takes each line for itself,
    which splits large files of lines.
    """
    paths = [path] if isinstance(path, str) else list(path)

    def load() -> DataFrame:
        return _with_lineage(spark.read.options(**_options(files)).text(paths, wholetext=multi_line))

    def empty() -> DataFrame:
        return spark.createDataFrame([], "value string, _source_file string, _modified_at timestamp")

    return parse_documents(read_or(load, empty), evolve, keep)


def stream_category_texts(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    files: str = "*.json",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Newly landed texts as a stream, for ``parse_documents``; the file source remembers what it has seen."""
    reader = spark.readStream.options(**_options(files))
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _with_lineage(reader.text(path, wholetext=multi_line))
