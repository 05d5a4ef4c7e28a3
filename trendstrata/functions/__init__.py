"""Column expressions; all of them compile to built-in Spark functions."""

from trendstrata.functions.dates import (
    ingestion_id,
    iso_utc,
    landing_date,
    landing_hour,
    parse_trending_date,
    text_to_instant,
    zoneless_to_instant,
)
from trendstrata.functions.keys import decode_key, decode_path, region_from_key, region_from_path
from trendstrata.functions.nested import flatten_struct
from trendstrata.functions.numbers import as_exact, exact_sum, per_hundred, ratio_half_up
from trendstrata.functions.text import strip, to_boolean, to_long

__all__ = [
    "as_exact",
    "exact_sum",
    "decode_key",
    "decode_path",
    "flatten_struct",
    "ingestion_id",
    "iso_utc",
    "landing_date",
    "landing_hour",
    "parse_trending_date",
    "per_hundred",
    "ratio_half_up",
    "region_from_key",
    "region_from_path",
    "strip",
    "text_to_instant",
    "to_boolean",
    "to_long",
    "zoneless_to_instant",
]
