"""Readers: raw statistics files, category documents, catalog tables."""

from trendstrata.sources.category_json import (
    parse_documents,
    read_category_json,
    stream_category_texts,
)
from trendstrata.sources.statistics_csv import read_raw_statistics, split_rejects
from trendstrata.sources.tables import dq_input, read_table, table_exists

__all__ = [
    "dq_input",
    "parse_documents",
    "read_category_json",
    "read_raw_statistics",
    "read_table",
    "split_rejects",
    "stream_category_texts",
    "table_exists",
]
