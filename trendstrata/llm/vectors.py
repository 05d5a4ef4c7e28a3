"""What the vector operators share: valid rows as bytes, and the best rows of a query."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def element(df: DataFrame, column: str = "embedding") -> str:
    """numpy type of the components as they are shipped."""
    kind = df.schema[column].dataType
    if not isinstance(kind, T.ArrayType):
        raise TypeError(f"{column} is no array")
    return "<f4" if isinstance(kind.elementType, T.FloatType) else "<f8"


def valid(df: DataFrame, column: str = "embedding", zero: bool = False) -> DataFrame:
    """``vec_id, vec`` of rows with an id whose components are all there and finite; zero vectors only if asked for."""
    vec = F.col(column)
    numbers = ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    keep = F.col("vec_id").isNotNull() & (F.size(vec) > 0) & numbers
    if not zero:
        keep &= F.exists(vec, lambda x: x != 0)
    kind = "float" if element(df, column) == "<f4" else "double"
    return df.filter(keep).select("vec_id", vec.cast(f"array<{kind}>").alias("vec"))


def matrices(batch: pa.RecordBatch, name: str = "vec") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each length in a batch."""
    column = batch.column(batch.schema.get_field_index(name))
    offsets = np.asarray(column.offsets).astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, values[offsets[rows][:, None] + np.arange(size)[None, :]]


def best(found: DataFrame, k: int, ascending: bool) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of each query, ties to the smaller id."""
    score = F.asc("score") if ascending else F.desc("score")
    once = found.groupBy("query_id", "vec_id").agg((F.min if ascending else F.max)("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(score, "vec_id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
