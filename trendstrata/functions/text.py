"""Lenient text conversions that stay NULL-on-error under ANSI mode.

Patterns decide before anything is cast.  A failing ``try_cast`` raises and
catches an exception per row, which on dirty columns costs more than the rest
of the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHITESPACE = " \t\n\r\f\v"
_PAD = r"[\s\p{Cntrl}]*"
# Eighteen digits always fit.
_INTEGER = rf"^{_PAD}[+-]?[0-9]{{1,18}}{_PAD}\z"
# Longer numbers, and a fraction that is cut off; there is a digit or a point.
_NUMBER = rf"^{_PAD}([+-]?[0-9]*)(?:(?<=[0-9])|\.[0-9]*){_PAD}\z"

# The words the cast to boolean knows.
TRUE_WORDS = ("t", "true", "y", "yes", "1")
FALSE_WORDS = ("f", "false", "n", "no", "0")


def strip(col: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(col, F.lit(_WHITESPACE))


def to_long(col: Column) -> Column:
    """Text to 64-bit integer; a fraction is cut off, anything else bad is NULL.

    ``12.7`` is 12 and ``.5`` is 0, as in a non-ANSI cast.
    """
    text = col.cast("string")
    whole = F.regexp_extract(text, _NUMBER, 1)
    truncated = F.when(whole.isin("", "+", "-"), F.lit(0).cast("long")).otherwise(whole.try_cast("long"))
    return F.when(text.rlike(_INTEGER), text.try_cast("long")).when(text.rlike(_NUMBER), truncated)


def to_boolean(col: Column) -> Column:
    """Text to boolean; an unknown word is NULL."""
    word = strip(F.lower(col))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def quoted(name: str) -> str:
    """A column's name as SQL text."""
    return f"`{name.replace('`', '``')}`"
