"""Session helpers.  Library code never changes a session it was given."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# The JVM does not compile methods of more than 8000 bytes.  Beyond that, wide
# projections run faster as several methods than as one whole stage.
METHOD_LIMIT = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def local_session(cores: int | str = "*", app: str = "trendstrata", memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    parallelism = "8" if cores == "*" else str(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", parallelism)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config(map=METHOD_LIMIT)
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    In local mode without it (tests, a laptop) one temporary folder is made
    and registered as the checkpoint folder of the context.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not context.getCheckpointDir() and context.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return (named or context.getCheckpointDir()).rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """The rows, stored in a new folder that all executors can reach."""
    folder = fresh_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
