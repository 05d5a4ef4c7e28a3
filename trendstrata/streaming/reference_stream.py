"""Category documents as they land, into the same silver table as the batch.

Which file counts for a region is kept in the state store of the stream: one short
row per region, however long the table and however many files have landed.  A batch
reads again only the files that have come to count with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from trendstrata.functions import region_from_key
from trendstrata.plans.reference import BY_ARRIVAL, BY_KEY, silver_reference, with_order
from trendstrata.session import fresh_folder
from trendstrata.sinks.tables import write_table
from trendstrata.sources.category_json import document_heads, read_category_json, stream_category_texts

ORDERS = {"arrival": BY_ARRIVAL, "key": BY_KEY}

_CHANGES = "region string, _source_file string, error string"
_WINNER = "modified_at long, place string, file string"


def _newest(by_arrival: bool):
    """The file that counts, if it is not the one that did before, and the documents without rows."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else None
        best, rejects = held, []
        for frame in frames:
            for file, at, place, error in zip(frame["_source_file"], frame["_at"], frame["_order"], frame["error"], strict=True):
                if error is not None:
                    rejects.append((key[0], file, error))
                    continue
                one = (int(at) if by_arrival else 0, place, file)
                # A file that lands again under its name counts with what it holds now.
                if best is None or one[:2] >= tuple(best)[:2]:
                    best = one
        if best is not held:
            state.update(best)
            rejects.append((key[0], best[2], None))
        yield pd.DataFrame(rejects, columns=["region", "_source_file", "error"])

    return update


def _path(file: str) -> str:
    """A file's name as a path: signs that stand for other names are not meant so."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", file)


def start_reference_stream(
    spark: SparkSession,
    source: str,
    table: str,
    path: str,
    checkpoint: str,
    rejects_path: str,
    order: str = "arrival",
    multi_line: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Process what has landed since the last call, then stop.

    Each batch replaces the partitions of the regions whose file has changed.  With
    ``order="arrival"`` the document that landed last counts; with ``"key"``
    the greatest key, whatever the batches, as in a batch run over all files.

    A batch that is run again after a failure gives the same state: rows
    replace their region and rejects replace their batch number.  Landed files must stay
    where they are until their batch is done.
    """
    columns = ORDERS[order]

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        folder = fresh_folder(session, "changes")
        batch.write.parquet(folder)
        changes = session.read.schema(batch.schema).parquet(folder)
        # One file per region.
        files = [_path(r["_source_file"]) for r in changes.filter("error IS NULL").collect()]
        if files:
            docs = read_category_json(session, files, multi_line)
            write_table(silver_reference(docs, columns), table, path)
        rejects = changes.filter("error IS NOT NULL").select("_source_file", "error")
        write_table(rejects.withColumn("batch_id", F.lit(batch_id).cast("long")), path=rejects_path, keys=["batch_id"])

    texts = stream_category_texts(spark, source, multi_line, max_files_per_trigger=max_files_per_trigger)
    heads = with_order(document_heads(texts)).select(
        region_from_key(F.col("_source_file")).alias("_region"),
        "_source_file", F.unix_micros("_modified_at").alias("_at"), "_order", "error",
    )
    changed = heads.groupBy("_region").applyInPandasWithState(
        _newest(order == "arrival"), _CHANGES, _WINNER, "update", GroupStateTimeout.NoTimeout
    )
    return (
        changed.writeStream.foreachBatch(apply)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain_reference(
    spark: SparkSession, source: str, table: str, path: str, checkpoint: str, rejects_path: str, **options
) -> None:
    """``start_reference_stream``, wait for its end, and let this session see the new files.

    The batches write in a session of their own.
    """
    start_reference_stream(spark, source, table, path, checkpoint, rejects_path, **options).awaitTermination()
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)
