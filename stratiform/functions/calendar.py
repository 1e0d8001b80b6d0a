"""Calendar and clock expressions shared by the dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first hour that no longer belongs to each part of the day.
PARTS_OF_DAY = (("Night", 6), ("Morning", 12), ("Afternoon", 18), ("Evening", 24))

# Days of the week counted from Sunday = 1.
WEEKEND_DAYS = (1, 7)


def date_key(moment: Column) -> Column:
    """Smart date key yyyymmdd as int, computed without formatting text."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def time_key(moment: Column) -> Column:
    """Minute of the day, 0 to 1439."""
    return F.hour(moment) * 60 + F.minute(moment)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end; negative when the end comes first."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(*WEEKEND_DAYS)


def part_of_day(hour: Column) -> Column:
    *bounded, (rest, _) = PARTS_OF_DAY
    label = F
    for name, before in bounded:
        label = label.when(hour < before, F.lit(name))
    return label.otherwise(F.lit(rest))
