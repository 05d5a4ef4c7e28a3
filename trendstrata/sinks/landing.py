"""Raw documents with their envelope, in Hive-style folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trendstrata.functions import ingestion_id, iso_utc, landing_date, landing_hour, strip

LANDING_KEYS = ("region", "date", "hour")


def with_envelope(
    docs: DataFrame, source: str, at: Column | None = None, counted_as: str | None = "video_count"
) -> DataFrame:
    """Add ``_pipeline_metadata`` and the folder values of the run time.

    ``counted_as`` names the envelope's item count; None leaves it out.
    """
    when = F.current_timestamp() if at is None else at
    region = strip(F.lower("region"))
    envelope = {
        "ingestion_id": ingestion_id(when),
        "region": region,
        "ingestion_timestamp": iso_utc(when),
    }
    if counted_as:
        count = F.coalesce(F.size("items"), F.lit(0)) if "items" in docs.columns else F.lit(0)
        envelope[counted_as] = F.greatest(count, F.lit(0)).cast("long")
    envelope["source"] = F.lit(source)
    return docs.withColumns(
        {
            "_pipeline_metadata": F.struct(*[column.alias(name) for name, column in envelope.items()]),
            "region": region,
            "date": landing_date(when),
            "hour": landing_hour(when),
        }
    )


def land_raw(
    docs: DataFrame,
    path: str,
    source: str,
    at: Column | None = None,
    keys: Sequence[str] = LANDING_KEYS,
    counted_as: str | None = "video_count",
    replace: bool = False,
    documents_per_file: int = 1000,
) -> int:
    """Store the documents as JSON lines below ``region=/date=/hour=``; returns how many.

    ``replace`` empties the folders that get documents first, so that landing
    again on one day leaves the later landing alone.  Readers take a file as a
    whole, so no file holds more than ``documents_per_file``; there are more files then.
    """
    landed = with_envelope(docs, source, at, counted_as)
    unused = [c for c in ("date", "hour") if c not in keys]
    counted = Observation()
    rows = landed.drop(*unused).observe(counted, F.count(F.lit(1)).alias("documents"))
    writer = rows.write.mode("overwrite" if replace else "append").partitionBy(*keys)
    writer.options(partitionOverwriteMode="dynamic", maxRecordsPerFile=documents_per_file).json(path)
    return counted.get["documents"]
