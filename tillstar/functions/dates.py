"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sunday_week(day: Column) -> Column:
    """Week of the year, weeks starting on Sunday, days before the first Sunday in week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


# Fixed values: (month, day) pairs counted as holidays.
HOLIDAYS = ((12, 25), (1, 1), (7, 4))


def is_holiday(day: Column) -> Column:
    return (F.month(day) * 100 + F.day(day)).isin([m * 100 + d for m, d in HOLIDAYS])


def noon(day: Column) -> Column:
    """Zone-free timestamp at 12:00 of the day."""
    return day.cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")


def seconds_between(first: Column, last: Column) -> Column:
    return F.timestamp_diff("SECOND", first, last)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def time_of_day(moment: Column) -> Column:
    """`HH:mm:ss` text; Spark's parquet tables have no time-of-day column."""
    return F.date_format(moment, "HH:mm:ss")
