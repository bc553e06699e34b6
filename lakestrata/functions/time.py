"""Hour alignment, calendar parts and labels. Times are wall-clock (timestamp without zone)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Day-part limits (first hour, last hour, label); every other hour is 'Night'.
DAY_PARTS = [(5, 11, "Morning"), (12, 16, "Afternoon"), (17, 21, "Evening")]
NIGHT = "Night"
# Sunday is day 1. Rush hours apply to Monday..Friday.
WEEKEND_DAYS = [1, 7]
RUSH_HOURS = [7, 8, 9, 16, 17, 18, 19]
# First month of each season by month number.
SEASONS = [((12, 1, 2), "Winter"), ((3, 4, 5), "Spring"), ((6, 7, 8), "Summer"), ((9, 10, 11), "Autumn")]


def hour_of(col: Column) -> Column:
    """The start of the hour, as wall-clock time.

    Built from the parts of the time, as truncation would go through the session's zone and move hours
    that its clock change skips.
    """
    zero = F.lit(0)
    return F.make_timestamp_ntz(F.year(col), F.month(col), F.dayofmonth(col), F.hour(col), zero, zero)


def wall_seconds(col: Column) -> Column:
    """Whole seconds of the wall clock since 1970, in days of 86,400 seconds whatever the zone."""
    day = F.unix_date(col.cast("timestamp_ntz").cast("date")).cast("long")
    return day * 86400 + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)


def month_of(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def minutes_between(start: Column, end: Column, digits: int = 2) -> Column:
    """Minutes on the wall clock from whole seconds."""
    seconds = wall_seconds(end) - wall_seconds(start)
    return F.round(seconds / F.lit(60.0), digits).cast("double")


def day_part(hour: Column) -> Column:
    label = F.lit(NIGHT)
    for first, last, name in reversed(DAY_PARTS):
        label = F.when(hour.between(first, last), name).otherwise(label)
    return label


def is_weekend(day_of_week: Column) -> Column:
    return day_of_week.isin(WEEKEND_DAYS)


def is_rush_hour(day_of_week: Column, hour: Column) -> Column:
    return ~is_weekend(day_of_week) & hour.isin(RUSH_HOURS)


def season(month: Column) -> Column:
    """Meteorological season of a month number, 'Unknown' for none."""
    label = F.lit("Unknown")
    for months, name in SEASONS:
        label = F.when(month.isin(list(months)), name).otherwise(label)
    return label
