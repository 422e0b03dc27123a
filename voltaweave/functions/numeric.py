"""Numbers from text, and arithmetic with explicit rules for missing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as a number: no type suffixes, digit separators or hexadecimal forms.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
NAN = r"(?i)^\s*[+-]?nan\s*$"


def _parsed(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), F.regexp_replace(text, r"^\s+|\s+$", "").try_cast("double"))


def to_float(text: Column) -> Column:
    """A double, or null for null, empty, N/A and anything else that is no number; NaN becomes null."""
    return F.when((text != "") & (text != "N/A"), _parsed(text))


def to_float_keeping_nan(text: Column) -> Column:
    """As :func:`to_float`, but NaN stays NaN."""
    return F.when(text.rlike(NAN), F.lit(float("nan"))).otherwise(to_float(text))


def to_float_with_comma(text: Column) -> Column:
    """As :func:`to_float`, with a decimal comma allowed and more marks for missing values."""
    blank = F.regexp_replace(text, r"^\s+|\s+$", "").isin("", "N/A", "N/D", "-", "NA")
    return F.when(~blank, _parsed(F.regexp_replace(text, ",", ".")))


def delta(now: Column, before: Column) -> Column:
    """``now - before`` to four places, null if either is missing."""
    return F.round(now - before, 4)


def add_known(*values: Column) -> Column:
    """The sum of the values that are there to four places, null if none is."""
    total = sum((F.coalesce(v, F.lit(0.0)) for v in values), F.lit(0.0))
    return F.when(F.coalesce(*values).isNotNull(), F.round(total, 4))


def less_pending(available: Column, pending: Column) -> Column:
    """``available - pending`` to four places, a missing pending value counting as 0."""
    return F.round(available - F.coalesce(pending, F.lit(0.0)), 4)


def zero_as_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0.0))


def percent_floor(part: Column, whole: Column) -> Column:
    """Whole percent, rounded down; null for an empty whole."""
    return F.floor(100 * part / F.nullif(whole, F.lit(0))).cast("long")
