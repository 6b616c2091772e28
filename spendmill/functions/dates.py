"""Dates that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One- and two-digit months and days; a bare year or year-month is not a date.
DATE_PATTERN = "yyyy-M-d"


def lenient_date(text: Column | str) -> Column:
    """Date of a text, null when it is not one."""
    return F.try_to_date(text, DATE_PATTERN)


def strict_date(text: Column | str) -> Column:
    """Date of a text; text that is not a date ends the query with an error."""
    return F.to_date(text, DATE_PATTERN)
