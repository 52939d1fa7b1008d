"""Reading numbers and dates out of free text, safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_YEAR = "MMM-yyyy"


def strict_int(c: Column) -> Column:
    """Integer value of whole-number text, else null (``'1.5'`` is null)."""
    return c.try_cast("int")


def truncated_int(c: Column) -> Column:
    """Integer part of plain decimal text, else null (``'1.5'`` is 1, ``'1e3'`` null).

    Counts often arrive as ``'0.0'``; this is how a non-ANSI cast reads them.
    """
    whole = F.regexp_extract(F.trim(c.cast("string")), r"^([+-]?\d+)(?:\.\d*)?$", 1)
    return whole.try_cast("int")


def digits_only(c: Column, keep: str = "0-9") -> Column:
    """Drop every character outside ``keep``, then read an integer (or null)."""
    return F.regexp_replace(c, f"[^{keep}]", "").try_cast("int")


def years_from_months(c: Column) -> Column:
    """Whole years in text such as ``' 36 months'``; null when it has no digits."""
    return F.floor(digits_only(c) / 12).cast("int")


def month_year(c: Column) -> Column:
    """First day of a month written like ``Dec-2015``, or null."""
    return F.try_to_date(c, MONTH_YEAR)
