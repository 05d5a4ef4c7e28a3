"""An absent folder reads as an empty one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame


def read_or(load: Callable[[], DataFrame], empty: Callable[[], DataFrame]) -> DataFrame:
    """``load()``, or ``empty()`` where the path does not exist yet."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty()
        raise
