"""Which files a table has been made from, and what has changed in the feed since."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstrata.functions import decode_path, region_from_path
from trendstrata.sources.missing import read_or

_SAME = ["path", "modified_at", "length"]


def listed_files(spark: SparkSession, path: str, files: str = "*.csv") -> DataFrame:
    """The files below ``path`` with time and size; nothing in them is read."""
    options = {"recursiveFileLookup": "true", "pathGlobFilter": files}
    found = read_or(
        lambda: spark.read.format("binaryFile").options(**options).load(path),
        lambda: spark.createDataFrame([], "path string, modificationTime timestamp, length long").withColumn(
            "_metadata", F.struct(F.lit("").alias("file_path"))
        ),
    )
    key = F.col("_metadata.file_path")
    return found.select(
        "path",
        F.col("modificationTime").alias("modified_at"),
        "length",
        F.lower(F.trim(region_from_path(key))).alias("region"),
        decode_path(key).alias("_source_file"),
    )


@dataclass(frozen=True)
class Change:
    """The files to read, the regions they belong to, and those of them whose stored rows no longer count."""

    files: list[str]
    regions: list[str]
    anew: list[str]
    vanished: list[str]


def changes(listed: DataFrame, manifest: DataFrame) -> Change:
    """What is to be read so that a table made from ``manifest`` becomes one made from ``listed``.

    New files are read alone.  Where a file has changed or gone, what it gave cannot be told from
    the rest, so its region is read anew.  The lists are part of the file listing,
    which the driver holds for any read of the folder.
    """
    known = manifest.select(*_SAME)
    fresh = listed.join(known, _SAME, "left_anti").select("path", "region").collect()
    gone = manifest.join(listed.select(*_SAME), _SAME, "left_anti").select(F.coalesce("region", F.lit(""))).distinct()
    anew = {r[0] for r in gone.collect()}
    again = listed.filter(F.col("region").isin(sorted(anew))).select("path", "region").collect() if anew else []
    files = {r["path"] for r in [*fresh, *again]}
    regions = {r["region"] for r in [*fresh, *again]}
    vanished = anew - {r["region"] for r in again}
    return Change(sorted(files), sorted(regions | anew), sorted(anew), sorted(vanished))
