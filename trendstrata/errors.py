"""Failures of Spark, in analysis or while running."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

SPARK_ERRORS = (PySparkException, Py4JJavaError)


def reason(error: BaseException) -> str:
    """The message without the stack trace of the JVM."""
    return str(error).split("\n\tat ", 1)[0]
