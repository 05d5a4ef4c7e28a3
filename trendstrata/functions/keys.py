"""Facts read from file keys and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendstrata.functions.text import strip

_PATH_REGION = r"(?i)(?:^|/)region=([^/]*)/"
_KEY_REGION = r"(?i)(?:^|/)region=([^/=]*)"
_FILE_NAME = r"([^/]*)$"
_TWO_CHARACTERS = r"(?s)^..$"


def decode_key(col: Column) -> Column:
    """Undo the percent/plus encoding of an arrival notice's key."""
    return F.coalesce(F.try_url_decode(col), col)


def decode_path(col: Column) -> Column:
    """Undo the percent encoding of a file path; a plus sign stays a plus sign."""
    return decode_key(F.replace(col, F.lit("+"), F.lit("%2B")))


def region_from_path(path: Column) -> Column:
    """Value of the ``region=`` folder in any letter case; empty if there is none."""
    return F.regexp_extract(decode_path(path), _PATH_REGION, 1)


def region_from_key(key: Column) -> Column:
    """Region of a reference document.

    The first ``region=`` segment decides, even when empty; otherwise a
    two-letter file-name prefix of a ``*_category_id*`` file; else ``unknown``.
    """
    name = F.regexp_extract(key, _FILE_NAME, 1)
    prefix = F.lower(F.substring_index(name, "_", 1))
    named = F.contains(F.lower(name), F.lit("_category_id")) & prefix.rlike(_TWO_CHARACTERS)
    return (
        F.when(key.rlike(_KEY_REGION), strip(F.lower(F.regexp_extract(key, _KEY_REGION, 1))))
        .when(named, prefix)
        .otherwise(F.lit("unknown"))
    )
