"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from trendstrata.session import fresh_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Let Python workers get 1024 rows at a time where the session still has Spark's default of 10,000.

    Rows of these operators hold whole texts; ten thousand of them, on both
    sides of the pipe and for every core, are most of an executor's spare memory.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "1024")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage: values computed once (also row ids) stay the same when an
    executor is lost, and later steps read only the columns they use.
    """
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame, *keys: str, order: tuple[str, ...] = ()) -> DataFrame:
    """Rows of equal ``keys`` together and in order, for a streaming pass over each partition."""
    parts = shuffle_parts(df.sparkSession)
    return df.repartition(parts, *keys).sortWithinPartitions(*keys, *order)


def slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch where the running sum of ``sizes`` passes multiples of ``most``."""
    if batch.num_rows == 0:
        return
    group = np.cumsum(sizes) // most
    edges = np.flatnonzero(np.diff(group)) + 1
    for lo, hi in zip([0, *edges], [*edges, batch.num_rows], strict=True):
        yield batch.slice(lo, hi - lo)


def text_sizes(column: pa.Array) -> np.ndarray:
    """Bytes of each text; NULL has none."""
    return pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column and the ``n + 1`` offsets into them; NULL is empty."""
    column = column.fill_null("").cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, np.uint64)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(32))


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of equal values."""
    if len(keys) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    return starts, np.concatenate([starts[1:], [len(keys)]])
