"""The run ledger and the alerts table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstrata.schemas import LEDGER


def _ledger(df: DataFrame, run_id: str, stage: str, values: dict[str, Column]) -> DataFrame:
    fixed = {"run_id": F.lit(run_id), "stage": F.lit(stage), "recorded_at": F.current_timestamp()}
    values = fixed | values
    return df.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER.fields]
    )


def ledger_row(
    spark: SparkSession,
    run_id: str,
    stage: str,
    source: str | None = None,
    rows_written: int | None = None,
    path: str | None = None,
    error: str | None = None,
) -> DataFrame:
    """One stage's outcome."""
    values = {
        "source": F.lit(source),
        "rows_written": F.lit(rows_written),
        "path": F.lit(path),
        "error": F.lit(error),
    }
    return _ledger(spark.range(1), run_id, stage, values)


def ledger_per_file(
    rows: DataFrame, rejects: DataFrame, run_id: str, stage: str, path: str
) -> DataFrame:
    """Rows written per source file and region, and the files that failed."""
    written = rows.groupBy("_source_file", "region").agg(F.count(F.lit(1)).alias("_rows"))
    done = _ledger(
        written,
        run_id,
        stage,
        {
            "source": F.col("_source_file"),
            "region": F.col("region"),
            "rows_written": F.col("_rows"),
            "path": F.concat(F.lit(f"{path.rstrip('/')}/region="), "region"),
        },
    )
    failed = _ledger(rejects, run_id, stage, {"source": F.col("_source_file"), "error": F.col("error")})
    return done.unionByName(failed)


def append_ledger(entries: DataFrame, path: str) -> None:
    entries.hint("rebalance").write.mode("append").parquet(path)


def append_alerts(failed: DataFrame, path: str, run_id: str) -> None:
    """Keep the failed records; nothing is sent anywhere."""
    failed.withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(path)
