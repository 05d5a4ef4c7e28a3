"""Dates and instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The short form is year.day.month, each of two digits, in 20xx.
SHORT_DATE = r"^([0-9]{2})\.([0-9]{2})\.([0-9]{2})\z"
AS_ISO = "20$1-$3-$2"

_ZONE_SUFFIX = r"(?i)(z|utc|gmt|[+-]\d{1,2}(:?\d{2})?)\s*$"
_DATE_ONLY = r"^\s*\d{4}(-\d{1,2}){0,2}\s*$"


def parse_trending_date(col: Column) -> Column:
    """Date from either the short form or ISO text; unparseable text is NULL.

    The short form is rewritten as ISO text, which is read much faster than a
    date pattern and does not raise on bad days.
    """
    return F.regexp_replace(col, SHORT_DATE, AS_ISO).try_cast("date")


def text_to_instant(col: Column) -> Column:
    """ISO text to timestamp.  Text without a zone means UTC in any session."""
    parsed = F.try_to_timestamp(col)
    zoned = col.rlike(_ZONE_SUFFIX) & ~col.rlike(_DATE_ONLY)
    return F.when(zoned, parsed).otherwise(zoneless_to_instant(parsed))


def zoneless_to_instant(col: Column) -> Column:
    """A wall-clock time taken as UTC, whatever the session's zone."""
    return F.from_utc_timestamp(col.cast("timestamp"), F.current_timezone())


def _utc(at: Column) -> Column:
    return F.to_utc_timestamp(at, F.current_timezone())


def iso_utc(at: Column) -> Column:
    """ISO-8601 text of an instant in UTC with an explicit offset."""
    return F.concat(F.date_format(_utc(at), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def landing_date(at: Column) -> Column:
    return F.date_format(_utc(at), "yyyy-MM-dd")


def landing_hour(at: Column) -> Column:
    return F.date_format(_utc(at), "HH")


def ingestion_id(at: Column) -> Column:
    return F.date_format(_utc(at), "yyyyMMdd_HHmmss")
