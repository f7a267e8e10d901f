"""Time arithmetic. Times are timestamps without zone; elapsed time is exact to the microsecond."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

US_PER_DAY = 86_400_000_000
US_PER_HOUR = 3_600_000_000


def as_time(c: Column) -> Column:
    """Text, date or timestamp to a timestamp without zone; bad text is an error."""
    return c.cast("timestamp_ntz")


def micros(c: Column) -> Column:
    """Microseconds since 1970-01-01, whatever the session time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), as_time(c))


def elapsed_micros(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", as_time(start), as_time(end))


def los_days(admit: Column, discharge: Column) -> Column:
    """Length of stay in days, rounded half away from zero to two places."""
    return F.round(elapsed_micros(admit, discharge) / F.lit(float(US_PER_DAY)), 2)


def whole_days(start: Column, end: Column) -> Column:
    """Elapsed whole days, rounded down (an overlap gives a negative number)."""
    return F.floor(elapsed_micros(start, end) / F.lit(float(US_PER_DAY)))


def age_birth(admit: Column, dob: Column, hidden_from: int = 300, hidden_age: int = 90) -> Column:
    """Year difference; shifted birth dates of very old patients become ``hidden_age``."""
    years = F.year(admit) - F.year(dob)
    return F.when(years >= hidden_from, F.lit(hidden_age)).otherwise(years)


def age_anchor(admit: Column, anchor_age: Column, anchor_year: Column) -> Column:
    """Age from an anchor age and year; NULL when either is missing."""
    return anchor_age + F.year(admit) - anchor_year
