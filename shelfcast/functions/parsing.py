"""Lenient text-to-type parsing (ANSI-safe: malformed input gives null, never an error)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(c: Column) -> Column:
    """Text -> double; malformed text -> null; the text ``NaN`` -> NaN (kept, like a CSV cast)."""
    return c.try_cast("double")


def to_date(c: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(c, fmt)


# Fixed value: the pattern a request date must match in full (4-digit year,
# month and day with an optional leading zero; a day may also be a blank and a digit).
REQUEST_DATE_PATTERN = r"^([0-9]{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])$"


def request_date(c: Column) -> Column:
    """Parse a request date the way a lenient ``%Y-%m-%d`` parser does.

    Accepts ``2023-1-5`` and ``2023-01-05``; rejects blanks around the value, year 0 and
    impossible days such as ``2023-02-30``. Non-matching text gives null.
    """
    ok = c.rlike(REQUEST_DATE_PATTERN) & ~c.startswith("0000")
    # the pattern lets a day be written as a blank and one digit
    return F.when(ok, F.try_to_date(F.regexp_replace(c, "- ", "-"), "yyyy-M-d"))
