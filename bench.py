"""Headline timings: one warm-up, then the median of three, into a noop sink.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from trendstrata.catalogue.queries import QUERIES
from trendstrata.config import Settings
from trendstrata.operators import metrics, quality, serving
from trendstrata.plans import views
from trendstrata.plans.reference import silver_reference
from trendstrata.plans.silver import settle, silver_statistics, tallied_statistics
from trendstrata.session import fresh_folder, local_session
from trendstrata.sinks.tables import write_table
from trendstrata.sources.statistics_csv import CSV_FORMAT, read_raw_statistics

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_seconds(job: Callable[[], None]) -> float:
    job()
    taken = []
    for _ in range(RUNS):
        start = time.perf_counter()
        job()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 3)


def stored(spark: SparkSession, df: DataFrame, label: str, keys: list[str]) -> tuple[DataFrame, str]:
    path = fresh_folder(spark, label)
    write_table(df, path=path, keys=keys)
    return spark.read.parquet(path), path


def jobs(spark: SparkSession) -> dict[str, Callable[[], None]]:
    order = views.STAR_ORDER
    raw, _ = stored(spark, views.star_statistics(spark, SF_DIR), "raw", ["region"])
    silver, _ = stored(spark, silver_statistics(raw, order=order), "silver", ["region"])
    trending, _ = stored(spark, metrics.trending_analytics(silver), "trending", ["region"])
    channels, _ = stored(spark, metrics.channel_analytics(silver), "channel", ["region"])
    categories, _ = stored(spark, metrics.category_analytics(silver), "category", ["region"])
    lookup = views.nation_lookup(spark, SF_DIR)
    docs = views.text_documents(spark, SF_DIR)
    csv = fresh_folder(spark, "csv")
    plain = raw.drop(*order).repartition(16)
    plain.write.partitionBy("region").options(**CSV_FORMAT, encoding="ISO-8859-1").csv(csv)
    frames: dict[str, Callable[[], DataFrame]] = {
        "silver_statistics": lambda: silver_statistics(raw, order=order),
        "silver_tallied": lambda: settle(tallied_statistics(raw, order=order)),
        "csv_to_silver": lambda: silver_statistics(read_raw_statistics(spark, csv)),
        "trending_analytics": lambda: metrics.trending_analytics(silver),
        "channel_analytics": lambda: metrics.channel_analytics(silver, lookup),
        "category_analytics": lambda: metrics.category_analytics(silver, lookup),
        "quality_checks": lambda: quality.check_table(silver, "clean_statistics", Settings()),
        "reference_silver": lambda: silver_reference(docs),
        "top_days": lambda: serving.top_days(trending, "am"),
        "top_channels": lambda: serving.top_channels(channels),
        "category_counts": lambda: serving.category_counts(categories),
        "star_trending": lambda: QUERIES["star_trending"](spark, SF_DIR),
        "event_silver": lambda: QUERIES["event_silver"](spark, SF_DIR),
    }
    timed: dict[str, Callable[[], None]] = {name: lambda f=f: run(f()) for name, f in frames.items()}
    timed["silver_write"] = lambda: write_table(
        settle(tallied_statistics(raw, order=order)), path=fresh_folder(spark, "written"), balance=False
    )
    timed["gold_write"] = lambda: write_table(
        metrics.channel_analytics(silver, lookup), path=fresh_folder(spark, "written")
    )
    return timed


def main() -> None:
    spark = local_session(CPUS, app="bench", memory=os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: median_seconds(job) for name, job in jobs(spark).items()}
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(SF_DIR).name.removeprefix("sf")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
