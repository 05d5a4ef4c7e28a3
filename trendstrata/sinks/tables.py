"""Partitioned Snappy Parquet tables, in the catalog or by path.

A table that has been replaced as a whole lives in versions: each replacement is
written to a folder of its own below the table's path, and only when all of it
is there does the catalog's entry move to that folder, in one step.  A job that fails
leaves the rows that were there; readers see one version or the other.  The
version before stays for readers that are under way and goes with the next one.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendstrata.functions.text import quoted
from trendstrata.sinks.evolution import common_schema, fitted_rows, known_type, same_type

MODES = ("overwrite_partitions", "replace", "append")
_VERSION = "v-"


def write_table(
    df: DataFrame,
    name: str | None = None,
    path: str | None = None,
    keys: Sequence[str] = ("region",),
    mode: str = "overwrite_partitions",
    balance: bool = True,
    measures: Sequence[Column] = (),
) -> dict[str, int]:
    """Write ``df`` once and return what was counted on the way, ``rows`` at least.

    ``overwrite_partitions`` replaces only the partitions present in ``df``,
    ``replace`` the whole table, at once and only if the job succeeds; it needs a
    ``name`` and a ``path``.  With a ``name`` the catalog table is created or
    extended by new columns; with a ``path`` alone the files are the table.

    A column whose type differs from the stored one takes the least type that
    holds both.  Where that is not the stored type, the rows that are there are
    written again as that type, into a new version.

    ``balance`` lets adaptive execution even out the files: small partitions
    share a task, a large one is split by size over many.  It is one more
    shuffle; leave it out where the rows come in few, large tasks already.

    The counts are taken in the writing stage itself, whose tasks report once
    each, so lost executors do not distort them.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if name is None and path is None:
        raise ValueError("a table needs a name or a path")
    if mode == "replace" and (name is None or path is None):
        raise ValueError("to replace a table as a whole it needs a name and a path")
    counted = Observation()
    storable = fitted_rows(df, known_type(df.schema) or T.StructType([]))
    if name is not None and df.sparkSession.catalog.tableExists(name):
        write = _existing(df.sparkSession, name, path, storable.schema, keys, mode)
        storable = fitted_rows(storable, write.schema)
    else:
        write = _New(name, path, storable.schema, keys, mode)
    laid_out = storable.hint("rebalance", *keys) if balance else storable
    write(laid_out.observe(counted, F.count(F.lit(1)).alias("rows"), *measures))
    return dict(counted.get)


def _save(df: DataFrame, folder: str, keys: Sequence[str], mode: str) -> None:
    writer = df.write.mode(mode).partitionBy(*keys).format("parquet").option("compression", "snappy")
    writer.option("partitionOverwriteMode", "dynamic").save(folder)


def write_routed(
    df: DataFrame,
    tables: Mapping[str, tuple[str, Sequence[str]]],
    path: str,
    keys: Sequence[str] = ("region",),
    mode: str = "replace",
    measures: Sequence[Column] = (),
) -> dict[str, int]:
    """Write the rows of ``df`` to several tables in one pass, by its column ``kind``.

    ``tables`` maps a kind to a table's name and columns.  The tables share the versions
    below ``path``, each with a folder of its own in them.  Returns the rows of each kind,
    and the ``measures``.  ``overwrite_partitions`` replaces, in each table, the partitions that get rows.
    """
    if mode not in ("replace", "overwrite_partitions"):
        raise ValueError("mode must be replace or overwrite_partitions")
    spark = df.sparkSession
    counted = Observation()
    counts = [F.count_if(F.col("kind") == kind).alias(kind) for kind in tables]
    rows = df.observe(counted, *counts, *measures)
    layout = ["kind", *keys]
    if mode == "overwrite_partitions":
        current = {location(spark, name).rsplit("/", 1)[0] for name, _ in tables.values()}
        if len(current) != 1:
            raise ValueError(f"{', '.join(name for name, _ in tables.values())} do not share a version")
        _save(rows, current.pop(), layout, "overwrite")
    else:
        known = {name for name, _ in tables.values() if spark.catalog.tableExists(name)}
        before = {_version_of(location(spark, name)) for name in known}
        with _Version(spark, path) as folder:
            _save(rows, folder, layout, "errorifexists")
            for kind, (name, columns) in tables.items():
                schema = T.StructType([df.schema[c] for c in columns])
                _point(spark, name, schema, keys, f"{folder}/kind={kind}")
        _forget(spark, path, {_version_of(folder), *before})
    for name, _ in tables.values():
        spark.catalog.refreshTable(name)
    return dict(counted.get)


class _New:
    """The first rows of a table."""

    def __init__(self, name: str | None, path: str | None, schema: T.StructType, keys: Sequence[str], mode: str):
        self.name, self.path, self.schema, self.keys, self.mode = name, path, schema, keys, mode

    def __call__(self, df: DataFrame) -> None:
        if self.mode == "replace":
            with _Version(df.sparkSession, self.path) as folder:
                _save(df, folder, self.keys, "errorifexists")
                _create(df.sparkSession, self.name, _keys_last(self.schema, self.keys), folder)
        elif self.name is None:
            _save(df, self.path, self.keys, "append" if self.mode == "append" else "overwrite")
        else:
            writer = df.write.mode("overwrite").partitionBy(*self.keys).format("parquet").option("compression", "snappy")
            # The entry keeps this option, and later inserts go by it.
            writer = writer.option("partitionOverwriteMode", "dynamic")
            (writer.option("path", self.path) if self.path else writer).saveAsTable(self.name)


class _Stored:
    """More rows for a table that is there; ``schema`` is what they must fit."""

    def __init__(self, name: str, schema: T.StructType, keys: Sequence[str], mode: str):
        self.name, self.schema, self.keys = name, schema, keys
        self.mode = "append" if mode == "append" else "overwrite"



class _Partitioned(_Stored):
    """Into a table whose partitions the catalog knows."""

    def __call__(self, df: DataFrame) -> None:
        spark = df.sparkSession
        _add_columns(spark, self.name, self.schema)
        ordered = df.select(*[F.col(quoted(f.name)) for f in spark.table(self.name).schema.fields])
        ordered.write.mode(self.mode).option("partitionOverwriteMode", "dynamic").insertInto(self.name)


class _Current(_Stored):
    """Into the current version of a table; overwritten partitions come from a staging folder."""

    def __call__(self, df: DataFrame) -> None:
        spark = df.sparkSession
        _add_columns(spark, self.name, self.schema)
        _save(df, location(spark, self.name), self.keys, self.mode)
        spark.catalog.refreshTable(self.name)


class _NextVersion(_Stored):
    """As a new version, with the rows that stay, if any, as the new types."""

    def __init__(self, name: str, path: str, schema: T.StructType, keys: Sequence[str], mode: str, keep: bool):
        super().__init__(name, schema, keys, mode)
        self.path, self.keep = path, keep

    def __call__(self, df: DataFrame) -> None:
        spark = df.sparkSession
        before = location(spark, self.name)
        with _Version(spark, self.path) as folder:
            if self.keep:
                _save(fitted_rows(spark.table(self.name), self.schema), folder, self.keys, "errorifexists")
            _save(df, folder, self.keys, self.mode if self.keep else "errorifexists")
            _point(spark, self.name, self.schema, self.keys, folder)
        _forget(spark, self.path, {_version_of(folder), _version_of(before)})


def _existing(spark: SparkSession, name: str, path: str | None, schema: T.StructType, keys: Sequence[str], mode: str) -> _Stored:
    spark.catalog.refreshTable(name)
    table = spark.table(name).schema
    want = common_schema(table, schema)
    have = {f.name.lower(): f.dataType for f in table.fields}
    widened = any(not same_type(have.get(f.name.lower(), f.dataType), f.dataType) for f in want.fields)
    if mode == "replace" or widened:
        return _NextVersion(name, path or location(spark, name), want, keys, mode, keep=mode != "replace")
    kind = _Partitioned if _tracked(spark, name) else _Current
    return kind(name, want, keys, mode)


class _Version:
    """A new folder below the table's path, removed if what is done with it fails."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._folder = f"{path.rstrip('/')}/{_VERSION}{time.time_ns()}-{uuid.uuid4().hex[:8]}"

    def __enter__(self) -> str:
        return self._folder

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None:
            _remove(self._spark, self._folder)


def _version_of(folder: str) -> str:
    """The version that a folder is, or lies in."""
    return next((part for part in folder.split("/")[::-1] if part.startswith(_VERSION)), "")


def _forget(spark: SparkSession, path: str, kept: set[str]) -> None:
    for old in versions(spark, path):
        if old not in kept:
            _remove(spark, f"{path.rstrip('/')}/{old}")


def _add_columns(spark: SparkSession, name: str, schema: T.StructType) -> None:
    known = {f.name.lower() for f in spark.table(name).schema.fields}
    added = [f for f in schema.fields if f.name.lower() not in known]
    if added:
        columns = ", ".join(f"{quoted(f.name)} {_ddl(f.dataType)}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")


def _point(spark: SparkSession, name: str, schema: T.StructType, keys: Sequence[str], folder: str) -> None:
    """Let a table's entry name this folder."""
    want = _keys_last(schema, keys)
    if not spark.catalog.tableExists(name):
        _create(spark, name, want, folder)
        return
    have = {f.name.lower(): f.dataType for f in spark.table(name).schema.fields}
    same = all(same_type(have.get(f.name.lower(), f.dataType), f.dataType) for f in want.fields)
    if same and not _tracked(spark, name):
        _add_columns(spark, name, want)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_text(folder)}'")
    else:
        # The catalog cannot change a type, nor forget that it knows the partitions: a new
        # entry, once.  The files of an external table stay when its entry goes.
        if _details(spark, name).get("Type") == "MANAGED":
            raise ValueError(f"{name} is managed by the catalog: give it a path to change its types")
        spark.sql(f"DROP TABLE {name}")
        _create(spark, name, want, folder)
    spark.catalog.refreshTable(name)


def _keys_last(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    """Columns that are folder names are read after the others."""
    return T.StructType([*[f for f in schema.fields if f.name not in keys], *[schema[k] for k in keys]])


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        return f"struct<{', '.join(f'{quoted(f.name)}: {_ddl(f.dataType)}' for f in kind.fields)}>"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{_ddl(kind.keyType)}, {_ddl(kind.valueType)}>"
    return kind.simpleString()


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def _create(spark: SparkSession, name: str, schema: T.StructType, folder: str) -> None:
    """A catalog entry over a folder; its partitions are the folder's own, so that moving the entry moves them all."""
    columns = ", ".join(f"{quoted(f.name)} {_ddl(f.dataType)}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{_text(folder)}'")


def _tracked(spark: SparkSession, name: str) -> bool:
    return any(column.isPartition for column in spark.catalog.listColumns(name))


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}


def location(spark: SparkSession, name: str) -> str:
    """The folder that a catalog table's entry names."""
    return _details(spark, name)["Location"]


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folder names of the complete versions below a table's path."""
    root, files = _files(spark, path)
    if not files.exists(root):
        return []
    found = [s.getPath() for s in files.listStatus(root) if s.getPath().getName().startswith(_VERSION)]
    return [p.getName() for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]


def _remove(spark: SparkSession, folder: str) -> None:
    path, files = _files(spark, folder)
    files.delete(path, True)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """A path-only table; files written before a column was added read as NULL there."""
    return spark.read.option("mergeSchema", "true").parquet(path)
