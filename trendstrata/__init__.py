"""Layered analytics over daily popularity statistics, as plain Spark jobs.

Raw CSV / JSON folders become typed silver tables, silver tables are checked
by one aggregate per table, and gold summaries are built only when the checks
pass.  Every public function takes DataFrames and returns DataFrames; reading
and writing happen only in ``sources`` and ``sinks``.
"""

from trendstrata.config import Settings

__all__ = ["Settings"]
