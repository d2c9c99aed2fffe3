"""Wall-clock time expressions over TIMESTAMP_NTZ columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000


def midnight(day: Column) -> Column:
    return day.cast("date").cast("timestamp_ntz")


def rebase_date(ts: Column, day: Column) -> Column:
    """The same time of day on another date."""
    return midnight(day) + (ts - midnight(ts))


def _whole_units(start: Column, end: Column, unit: str) -> Column:
    """Length in whole units, cut toward zero.

    The difference of two TIMESTAMP_NTZ values is an interval whatever the session's zone; ``timestampdiff`` would send
    both through that zone, which moves times in the hour that a clock change skips.
    """
    return F.call_function("div", end - start, F.expr(f"INTERVAL {unit}"))


def delay_minutes(expected: Column, actual: Column) -> Column:
    """Whole minutes from the expected to the actual time, cut toward zero."""
    return _whole_units(expected, actual, "'1' MINUTE").cast("int")


def micros_between(start: Column, end: Column) -> Column:
    return _whole_units(start, end, "'0.000001' SECOND")


def micros_of_day(ts: Column, day: Column) -> Column:
    """Microseconds since the midnight of ``day``; negative before it."""
    return micros_between(midnight(day), ts)


def minutes_of_day(ts: Column, day: Column) -> Column:
    """Minutes since the midnight of ``day``, halves rounded to the even number."""
    return F.bround(micros_of_day(ts, day) / MICROS_PER_MINUTE, 0)


def us_date(day: Column) -> Column:
    return F.date_format(day, "MM/dd/yyyy")


def clock(ts: Column) -> Column:
    """HH:mm, taken from the text of the wall-clock time."""
    return F.substring(ts.cast("string"), 12, 5)
