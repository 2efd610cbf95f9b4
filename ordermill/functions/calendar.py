"""Calendar attributes of a day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels of the two kinds of days.
WEEKDAY, WEEKEND = "Weekday", "Weekend"


def every_day(first: Column, last: Column) -> Column:
    """Array of all days from first to last; NULL bounds give NULL."""
    return F.sequence(first, last, F.expr("interval 1 day"))


def weekday_label(day: Column) -> Column:
    return F.when(F.weekday(day) >= 5, WEEKEND).otherwise(WEEKDAY)


def day_counter(day: Column, first: Column, running: bool) -> Column:
    """Position of day counted from first, optionally restarting each January."""
    if running:
        return F.datediff(day, first) + 1
    return F.dayofyear(day) - F.dayofyear(first) + 1


def date_stamp(day: Column, padded: bool) -> Column:
    """Year, month and day run together as text."""
    if padded:
        return F.date_format(day, "yyyyMMdd")
    return F.concat(*(part(day).cast("string") for part in (F.year, F.month, F.dayofmonth)))
