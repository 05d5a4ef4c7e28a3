"""Rows as one file of JSON lines, written by many tasks."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from trendstrata.sources.manifest import listed_files

PIECE = 64 << 20  # bytes that a task copies at once
_BLOCK = 1 << 20


def _copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece to its place in the file.  A repeated task writes the same bytes to the same place."""
    for batch in batches:
        for piece in batch.to_pylist():
            with open(piece["part"], "rb") as part, open(piece["file"], "r+b") as file:
                part.seek(piece["start"])
                file.seek(piece["place"])
                left = piece["size"]
                while left:
                    block = part.read(min(left, _BLOCK))
                    if not block:
                        raise EOFError(f"{piece['part']} is shorter than listed")
                    file.write(block)
                    left -= len(block)
                file.flush()
                os.fsync(file.fileno())
        yield batch


def write_one_file(df: DataFrame, path: str) -> str:
    """The rows as one JSON file in the folder ``path``; returns its name.

    Many tasks write parts; then many tasks copy pieces of them, each to its own place.  What passes through
    the driver is the list of the parts.  Only a mounted folder can be written that way: elsewhere one task writes the file.
    """
    spark = df.sparkSession
    df.write.json(f"{path}/parts")
    listed = listed_files(spark, f"{path}/parts", "*.json").orderBy("path").collect()
    if not listed or not listed[0]["path"].startswith("file:"):
        df.coalesce(1).write.json(f"{path}/whole")
        return listed_files(spark, f"{path}/whole", "*.json").first()["path"]
    parts = [(re.sub("^file:/*", "/", r["path"]), r["length"]) for r in listed]
    ends = list(accumulate(length for _, length in parts))
    file = os.path.join(os.path.dirname(os.path.dirname(parts[0][0])), "all.json")
    with open(file, "wb") as whole:
        whole.truncate(ends[-1])
    pieces = [
        (part, file, start, min(PIECE, length - start), end - length + start)
        for (part, length), end in zip(parts, ends, strict=True)
        for start in range(0, length, PIECE)
    ]
    if pieces:
        shape = "part string, file string, start long, size long, place long"
        dealt = spark.createDataFrame(pieces, shape).repartition(len(pieces))
        dealt.mapInArrow(_copied, shape).write.format("noop").mode("overwrite").save()
    return f"file://{file}"
