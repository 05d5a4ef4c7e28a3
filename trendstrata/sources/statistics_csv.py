"""Raw statistics: CSV files of all regions in one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstrata.functions import decode_path, region_from_path
from trendstrata.schemas import CORRUPT, RAW_COLUMNS, RAW_STATISTICS
from trendstrata.sources.missing import read_or

# How the feed writes its files.
CSV_FORMAT = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}


def read_raw_statistics(
    spark: SparkSession,
    path: str | Sequence[str],
    encoding: str = "ISO-8859-1",
    multi_line: bool = True,
    files: str = "*.csv",
) -> DataFrame:
    """All raw columns as text, ``region`` from the path, the corrupt column, and the file.

    Sub-folders are searched at any depth for ``files``; rows that are too
    short, too long or broken are kept with their text in the corrupt column.

    A file with line breaks inside quotes cannot be split, so one file is one
    task: land many files of moderate size.  ``multi_line=False`` makes large
    files splittable where the feed has no such line breaks.
    """
    options = {
        **CSV_FORMAT,
        "encoding": encoding,
        "multiLine": str(multi_line).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "recursiveFileLookup": "true",
        "pathGlobFilter": files,
    }
    rows = read_or(
        lambda: spark.read.schema(RAW_STATISTICS)
        .options(**options)
        .csv([path] if isinstance(path, str) else list(path))
        .withColumns(
            {
                "region": region_from_path(F.col("_metadata.file_path")),
                "_source_file": decode_path(F.col("_metadata.file_path")),
            }
        ),
        lambda: spark.createDataFrame([], RAW_STATISTICS).withColumns({"region": F.lit(""), "_source_file": F.lit("")}),
    )
    return rows.select(*RAW_COLUMNS, "region", CORRUPT, "_source_file")


def split_rejects(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``; the rejects keep only region and the original text.

    Each side is its own scan of the files.
    """
    # Spark refuses to read nothing but the corrupt column, so the filter looks
    # at a data column as well; a length is never negative.
    parsed = F.length(F.concat_ws("", "video_id")) >= 0
    good = raw.filter(F.col(CORRUPT).isNull() & parsed).drop(CORRUPT)
    rejects = raw.filter(F.col(CORRUPT).isNotNull() & parsed).select("region", CORRUPT)
    return good, rejects
