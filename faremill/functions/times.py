"""Date and time differences as the warehouse dialect defines them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration_minutes(start: Column, end: Column) -> Column:
    """Whole seconds as minutes to 2 places; null for exactly 0, negative values survive."""
    minutes = F.round(F.timestamp_diff("SECOND", start, end) / F.lit(60.0), 2)
    return F.nullif(minutes, F.lit(0.0))


def whole_minutes(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("long")


def month_boundaries(later: Column, earlier: Column) -> Column:
    """Number of month starts crossed (31 Jan to 1 Feb is 1), not of full months."""

    def months(day: Column) -> Column:
        return F.year(day) * 12 + F.month(day)

    return (months(later) - months(earlier)).cast("long")


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")
