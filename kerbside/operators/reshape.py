"""Student monitor table in long form (one row per student, weekday and shift) and wide form (one column each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Weekday letters and shifts.
DAYS = ("M", "T", "W", "H", "F")
SHIFTS = ("Pickup", "Dropoff")
VALUES = ("route", "bus")


def monitor_wide(long: DataFrame, keys: tuple[str, ...] = ("record_id", "program_description")) -> DataFrame:
    """One row per student with ``<day>_<shift>_route`` and ``<day>_<shift>_bus`` columns.

    The list of columns is fixed, so no pass over the data is needed to find it. The largest text of a slot is found by a
    sorting aggregate; rows are dealt by their keys first, so that a large file's one task does not sort all of its rows.
    """
    slots = {
        f"{day}_{shift}_{value}".lower(): F.max(F.when((F.col("day") == day) & (F.col("shift") == shift), F.col(value)))
        for day in DAYS
        for shift in SHIFTS
        for value in VALUES
    }
    return long.repartition(*keys).groupBy(*keys).agg(*[c.alias(n) for n, c in slots.items()])


def monitor_long(wide: DataFrame, keys: tuple[str, ...] = ("record_id", "program_description")) -> DataFrame:
    """One row per student, weekday and shift, also where there is neither route nor bus. Needs no shuffle."""
    rows = [
        F.struct(
            F.lit(day).alias("day"),
            F.lit(shift).alias("shift"),
            *[F.col(f"{day}_{shift}_{value}".lower()).alias(value) for value in VALUES],
        )
        for day in DAYS
        for shift in SHIFTS
    ]
    return wide.select(*keys, F.inline(F.array(*rows)))
