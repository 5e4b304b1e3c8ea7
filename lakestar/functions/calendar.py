"""Date and time expressions with one fixed meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_epoch_millis(column: Column) -> Column:
    """Timestamp from milliseconds since 1970, milliseconds kept."""
    return F.timestamp_millis(column)


def date_key(column: Column) -> Column:
    """The day as an integer such as 20181105."""
    return F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)


def month_of_key(key: Column) -> Column:
    """The month out of an integer day key."""
    return F.floor(key / 100).cast("int") % 100


def is_weekend(column: Column) -> Column:
    """Saturday or Sunday."""
    return F.weekday(column) >= 5


def date_parts(column: Column) -> list[Column]:
    return [
        F.year(column).alias("year"),
        F.quarter(column).alias("quarter"),
        F.month(column).alias("month"),
        F.dayofmonth(column).alias("day"),
        F.weekofyear(column).alias("week"),
        is_weekend(column).alias("is_weekend"),
    ]


def time_parts(column: Column) -> list[Column]:
    """Hour to year; ISO week; weekday with Monday = 0."""
    return [
        F.hour(column).alias("hour"),
        F.dayofmonth(column).alias("day"),
        F.weekofyear(column).alias("week"),
        F.month(column).alias("month"),
        F.year(column).alias("year"),
        F.weekday(column).alias("weekday"),
    ]


def late_days(start: Column, end: Column, allowed_days: Column) -> Column:
    """Whole days from `start` to `end` beyond the allowed ones; 0 if in time or still open."""
    over = (end - start) - F.make_dt_interval(allowed_days)
    days = F.extract(F.lit("DAY"), over)
    return F.coalesce(F.greatest(days, F.lit(0)), F.lit(0)).cast("int")


def months_back(as_of: Column, months: int) -> tuple[Column, Column]:
    """First and last day of the month `months` before `as_of`."""
    start = F.trunc(F.add_months(as_of, -months), "MM")
    return start, F.last_day(start)
