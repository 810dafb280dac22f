"""Calendar column expressions (JVM built-ins only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_week(d: Column, week_start: str = "monday0") -> Column:
    """Weekday number: ``monday0`` gives Mon=0..Sun=6, ``sunday0`` gives Sun=0..Sat=6."""
    if week_start == "monday0":
        return F.weekday(d)
    if week_start == "sunday0":
        return F.dayofweek(d) - 1
    raise ValueError(f"week_start must be 'monday0' or 'sunday0', got {week_start!r}")


def is_weekend(dow: Column) -> Column:
    """1 when the weekday number is 5 or 6 under the chosen convention, else 0 (null date -> 0)."""
    return F.when(dow >= 5, F.lit(1)).otherwise(F.lit(0))


def calendar_columns(d: Column, week_start: str = "monday0") -> dict[str, Column]:
    dow = day_of_week(d, week_start)
    return {
        "day_of_week": dow.cast("int"),
        "day_of_month": F.dayofmonth(d).cast("int"),
        "week_of_year": F.weekofyear(d).cast("int"),
        "month": F.month(d).cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "year": F.year(d).cast("int"),
        "is_weekend": is_weekend(dow).cast("int"),
    }
