"""Statistics files with line breaks inside quotes, read in many tasks.

Spark cuts a text file into byte ranges at line ends, but whether a line begins a
record depends on all quotes before it.  So the files are passed over first:

1. Each range counts its quotes.  Their parity, summed up over the ranges before,
   tells whether a range begins inside quotes, and which range the record that is open there began in.
2. With that known, each range joins its lines to records by itself.  The ends of records
   that reach over a border are put together from the few ranges where that is so.
3. The records are parsed by the CSV functions of Spark, with the options of the reader.

A quote that does not open a field, nor close one, would turn everything after it
inside out.  Such records are recognised by their form, and the whole file is then read
in one task, as is a file that ends inside quotes.  So the rows are those of the one-task reader.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendstrata.functions import decode_path, region_from_path
from trendstrata.schemas import CORRUPT, RAW_COLUMNS, RAW_STATISTICS
from trendstrata.session import fresh_folder
from trendstrata.sources.missing import read_or
from trendstrata.sources.statistics_csv import CSV_FORMAT, read_raw_statistics

# Encodings in which the bytes of quotes, commas and line ends mean nothing else.
ENCODINGS = frozenset({"UTF-8", "ISO-8859-1", "US-ASCII", "WINDOWS-1252"})

_RANGE = ["file", "start", "size"]
_COUNTED = "file string, start long, size long, odd boolean, begins boolean, begins_inside boolean"
# Fields without quotes, or quoted with every inner quote doubled; the line end may leave a carriage return.
_REGULAR = r'^(?s:(?:[^",]*|"(?:[^"]|"")*")(?:,(?:[^",]*|"(?:[^"]|"")*"))*)\r?$'
COMPLETE, PIECE = 0, 1
_RECORDS = "file string, start long, owner long, kind int, first boolean, record binary"


def _lines(spark: SparkSession, path: str | Sequence[str], files: str) -> DataFrame:
    """Lines as bytes, in order inside their range, with the range they are in."""
    options = {"recursiveFileLookup": "true", "pathGlobFilter": files, "lineSep": "\n"}
    return (
        spark.read.options(**options)
        .text([path] if isinstance(path, str) else list(path))
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.col("_metadata.file_block_length").alias("size"),
            F.col("value").cast("binary").alias("line"),
        )
    )


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The lines of a batch, range by range."""
    start = batch.column("start").to_numpy()
    file = batch.column("file").dictionary_encode().indices.to_numpy()
    edges = np.flatnonzero((start[1:] != start[:-1]) | (file[1:] != file[:-1])) + 1
    for lo, hi in zip([0, *edges], [*edges, batch.num_rows], strict=True):
        if hi > lo:
            part = batch.slice(lo, hi - lo)
            yield tuple(part.column(c)[0].as_py() for c in _RANGE), part


def _quotes(lines: pa.Array) -> np.ndarray:
    return pc.count_substring(lines, b'"').to_numpy(zero_copy_only=False).astype(np.int64)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range (or part of one): parity of the quotes, and whether a record begins in it, from either state."""
    names = [part.split()[0] for part in _COUNTED.split(", ")]
    for batch in batches:
        rows = []
        for where, part in _stretches(batch):
            before = np.cumsum(_quotes(part.column("line")))
            inside = np.concatenate([[0], before[:-1]]) % 2
            rows.append((*where, bool(before[-1] % 2), bool((inside == 0).any()), bool((inside == 1).any())))
        kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.bool_()] * 3]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
        yield pa.RecordBatch.from_arrays(columns, names)


def _joined(lines: pa.Array, starts: np.ndarray, end: int) -> pa.Array:
    """Lines from each start to the next, put together again."""
    lists = pa.ListArray.from_arrays(pa.array(np.append(starts, end).astype(np.int32)), lines)
    return pc.binary_join(lists, b"\n")


def _joiner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each range, and pieces of those that reach over its borders.

    A record that is open at the end of a batch waits for the next one of its range.
    """
    names = [part.split()[0] for part in _RECORDS.split(", ")]
    current, inside, owner, held, seen = None, 0, 0, [], False

    def told(where: tuple, records: pa.Array, owners: list[int], kind: int, first: bool) -> pa.RecordBatch:
        n = len(records)
        firsts = np.zeros(n, bool)
        firsts[:1] = first
        columns = [
            pa.array([where[0]] * n, pa.string()), pa.array([where[1]] * n, pa.int64()), pa.array(owners, pa.int64()),
            pa.array([kind] * n, pa.int32()), pa.array(firsts), records.cast(pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def piece() -> Iterator[pa.RecordBatch]:
        """What is open when a range ends goes on in the next one, or began in one before."""
        if held:
            yield told(current, pa.array([b"\n".join(held)], pa.binary()), [owner], PIECE, owner == 0 and current[1] == 0 and not seen)

    for batch in batches:
        for where, part in _stretches(batch):
            if where != current:
                yield from piece()
                current, held, seen = where, [], False
                inside = int(part.column("inside")[0].as_py())
                owner = part.column("owner")[0].as_py() if inside else where[1]
            lines = part.column("line")
            after = (inside + np.cumsum(_quotes(lines))) % 2
            ends = np.flatnonzero(after == 0)  # the lines that end a record
            inside = int(after[-1])
            if len(ends) == 0:
                held += lines.to_pylist()
                continue
            lo = 0
            if held or (owner != where[1]):
                # The record that was open comes to its end.
                held += lines.slice(0, ends[0] + 1).to_pylist()
                whole = owner == where[1]
                yield told(where, pa.array([b"\n".join(held)], pa.binary()), [owner], COMPLETE if whole else PIECE, where[1] == 0 and not seen)
                held, owner, seen, lo = [], where[1], True, ends[0] + 1
                ends = ends[1:]
            if len(ends):
                starts = np.concatenate([[lo], ends[:-1] + 1])
                records = _joined(lines.slice(0, ends[-1] + 1), starts, ends[-1] + 1)
                yield told(where, records, [where[1]] * len(records), COMPLETE, where[1] == 0 and not seen)
                seen, lo = True, ends[-1] + 1
            held = lines.slice(lo).to_pylist()
    yield from piece()


def _checker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files that hold a record of irregular form."""
    for batch in batches:
        odd = pc.invert(pc.match_substring_regex(batch.column("record"), _REGULAR))
        found = pc.unique(batch.column("file").filter(odd))
        yield pa.RecordBatch.from_arrays([found], ["file"])


def _decoded(record: Column, encoding: str) -> Column:
    if encoding == "UTF-8":
        return F.make_valid_utf8(record.cast("string"))
    return F.decode(record, encoding)


def read_split_statistics(
    spark: SparkSession, path: str | Sequence[str], encoding: str = "ISO-8859-1", files: str = "*.csv"
) -> DataFrame:
    """As ``read_raw_statistics`` with ``multi_line``, where large files are read in many tasks.

    Reads the files twice before the result is asked for: to count quotes, and to look at the
    form of the records.  That is worth while for files of several ranges (``spark.sql.files.maxPartitionBytes``).
    Line ends are ``\\n`` or ``\\r\\n``.  A record must fit a row.
    """
    if encoding.upper() not in ENCODINGS:
        raise ValueError(f"encoding must be one of {', '.join(sorted(ENCODINGS))}")
    lines = read_or(lambda: _lines(spark, path, files), lambda: spark.createDataFrame([], "file string, start long, size long, line binary"))
    states = _range_states(lines)
    # A range that was not counted would begin in a state that nobody knows.
    lost = F.raise_error(F.lit("the ranges of the files have changed since they were counted"))
    known = lines.join(F.broadcast(states), _RANGE, "left")
    known = known.select(*_RANGE, F.coalesce("inside", lost).alias("inside"), "owner", "border", "line")
    whole = known.mapInArrow(_joiner, _RECORDS)
    records = whole.filter(F.col("kind") == COMPLETE).select("file", "first", "record")
    pieces = known.filter("border").mapInArrow(_joiner, _RECORDS).filter(F.col("kind") == PIECE)
    texts = F.transform(F.sort_array(F.collect_list(F.struct("start", "record"))), lambda p: F.hex(p["record"]))
    over = pieces.groupBy("file", "owner").agg(F.bool_or("first").alias("first"), texts.alias("_texts"))
    over = over.select("file", "first", F.unhex(F.array_join("_texts", "0A")).alias("record"))
    records = records.unionByName(over)

    irregular = {r["file"] for r in records.mapInArrow(_checker, "file string").distinct().collect()}
    irregular |= {r["file"] for r in states.filter("unclosed").select("file").distinct().collect()}
    rows = _parsed(records.filter(~F.col("file").isin(sorted(irregular))) if irregular else records, encoding)
    if irregular:
        names = [r["path"] for r in _paths(spark, path, files).filter(F.col("file").isin(sorted(irregular))).collect()]
        rows = rows.unionByName(read_raw_statistics(spark, names, encoding, files=files))
    return rows


def _paths(spark: SparkSession, path: str | Sequence[str], files: str) -> DataFrame:
    options = {"recursiveFileLookup": "true", "pathGlobFilter": files}
    found = spark.read.format("binaryFile").options(**options).load([path] if isinstance(path, str) else list(path))
    return found.select("path", F.col("_metadata.file_path").alias("file"))


def _range_states(lines: DataFrame) -> DataFrame:
    """One row per range: whether it begins inside quotes, where the record that is open there began, and whether one is open at a border.

    There is one row for each range of ``spark.sql.files.maxPartitionBytes``, so the table stays
    small beside the files: 80 MB for 100 TB.
    """
    spark = lines.sparkSession
    # Batches of one range come as rows of their own, in order.
    parts = lines.mapInArrow(_counter, _COUNTED).withColumn("_nth", F.monotonically_increasing_id())
    folder = fresh_folder(spark, "ranges")
    parts.write.parquet(folder)
    parts = spark.read.schema(parts.schema).parquet(folder)
    odd = F.col("odd").cast("int")
    before = Window.partitionBy("file").orderBy("start", "_nth").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    state = F.pmod(F.coalesce(F.sum(odd).over(before), F.lit(0)), F.lit(2))
    begins = F.when(state == 0, F.col("begins")).otherwise(F.col("begins_inside"))
    stated = parts.withColumns({"_state": state, "_begins": begins})
    ranges = stated.groupBy(*_RANGE).agg(
        F.min_by("_state", "_nth").alias("inside"), F.bool_or("_begins").alias("_begins"), F.sum(odd).alias("_odd")
    )
    owner = F.last(F.when(F.col("_begins"), F.col("start")), ignorenulls=True).over(upto)
    after = F.pmod(F.col("inside") + F.col("_odd"), F.lit(2))
    last = F.col("start") == F.max("start").over(Window.partitionBy("file"))
    return ranges.select(
        *_RANGE,
        F.col("inside").cast("int").alias("inside"),
        F.coalesce(owner, F.lit(0)).alias("owner"),
        ((F.col("inside") == 1) | (after == 1)).alias("border"),
        (last & (after == 1)).alias("unclosed"),
    )


def _parsed(records: DataFrame, encoding: str) -> DataFrame:
    options = {**CSV_FORMAT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "lineSep": "\x00"}
    del options["header"]
    text = F.regexp_replace(_decoded(F.col("record"), encoding.upper()), r"\r\z", "")
    told = records.filter(~F.col("first")).select("file", text.alias("_text")).filter(F.col("_text") != "")
    schema = RAW_STATISTICS.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    return told.select(F.from_csv("_text", schema, options).alias("_row"), "file").select(
        *[F.col(f"_row.{c}").alias(c) for c in RAW_COLUMNS],
        region_from_path(F.col("file")).alias("region"),
        F.col(f"_row.{CORRUPT}").alias(CORRUPT),
        decode_path(F.col("file")).alias("_source_file"),
    )
