"""Flattening of nested columns."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def _column(path: tuple[str, ...]) -> Column:
    return F.col(".".join("`" + part.replace("`", "``") + "`" for part in path))


def flatten_struct(df: DataFrame) -> DataFrame:
    """Every struct leaf as a top-level column; path parts joined by underscores.

    Arrays stay as they are, dots inside names become underscores too.
    A name that is taken already gets one more underscore at its end.
    """
    names: dict[str, tuple[str, ...]] = {}
    taken: set[str] = set()
    for path in _leaves(df.schema):
        name = "_".join(path).replace(".", "_")
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names[name] = path
    return df.select(*[_column(path).alias(name) for name, path in names.items()])
