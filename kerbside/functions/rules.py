"""Business rules as column expressions: exclusion, arrival choice, categories, lateness, tiers and yards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Half-day to direction code.
DIRECTION_OF_HALF_DAY = {"AM": "I", "PM": "O"}

# The set that stays in although its routes carry nobody, and the sets that never count.
KEPT_EMPTY_SET = "CHARLESTOWN HS Combo AM"
EXCLUDED_SET_PATTERNS = (
    "boston ballet",
    "strive.*shuttle",
    "horace mann afterschool pm",
    "fsb bos collab all day",
)

# Lateness flag to the number of minutes that is still on time.
LATENESS_LIMITS = {
    "on_time_by_anchor": 0,
    "within_5_min": 5,
    "within_10_min": 10,
    "true_on_time": 15,
    "late_10_min": 25,
    "late_15_min": 30,
    "late_25_min": 40,
    "late_30_min": 45,
}

# Minutes after midnight below which a planned arrival belongs to a tier, tested in this order.
TIME_TIERS = ((451, "7:30"), (511, "8:30"), (651, "9:30"))

# Garage to yard code.
YARD_CODES = {"FREEPORT": "Frpt", "READVILLE": "Read", "WASHINGTON": "Wash"}

# Arrivals more than this many minutes before the plan are early.
EARLY_LIMIT = -10


@dataclass(frozen=True)
class Cutoffs:
    """Smallest and largest delay in minutes, both exclusive, of a valid arrival."""

    lowest: float = -25.0
    highest: float = 60.0


def directions_for(half_days: tuple[str, ...] | list[str]) -> list[str]:
    """Direction codes of the asked half-days."""
    unknown = [h for h in half_days if h not in DIRECTION_OF_HALF_DAY]
    if unknown or not half_days:
        raise ValueError('half_days must be taken from "AM" and "PM"')
    return [DIRECTION_OF_HALF_DAY[h] for h in half_days]


def is_excluded(
    actual_load: Column,
    route_set_name: Column,
    kept_empty_set: str = KEPT_EMPTY_SET,
    patterns: tuple[str, ...] = EXCLUDED_SET_PATTERNS,
) -> Column:
    """Trips that do not count, such as shuttles; never null."""
    excluded = (actual_load == 0) & (route_set_name != kept_empty_set)
    for pattern in patterns:
        excluded = excluded | route_set_name.rlike(f"(?i){pattern}")
    return F.coalesce(excluded, F.lit(False))


def _strictly_between(value: Column, low: float, high: float) -> Column:
    return (value > low) & (value < high)


def _strictly_outside(value: Column, low: float, high: float) -> Column:
    return (value < low) | (value > high)


def choose_arrival(
    gps_delay: Column, system_delay: Column, gps_time: Column, system_time: Column, cutoffs: Cutoffs
) -> Column:
    """Arrival time out of two sources.

    A source that arrives in a band wins over one outside it, first for the narrow band that starts at the early
    limit, then for the cutoffs; the GPS source is asked first. Failing that the smaller absolute delay wins, and
    GPS on a tie. A missing time is filled from the other source.
    """
    rules = F.when(F.lit(False), gps_time)
    for low in (EARLY_LIMIT, cutoffs.lowest):
        inside = [_strictly_between(d, low, cutoffs.highest) for d in (gps_delay, system_delay)]
        outside = [_strictly_outside(d, low, cutoffs.highest) for d in (gps_delay, system_delay)]
        rules = rules.when(inside[0] & outside[1], gps_time).when(inside[1] & outside[0], system_time)
    rules = rules.when(F.abs(system_delay) < F.abs(gps_delay), system_time).otherwise(gps_time)
    return F.coalesce(rules, gps_time, system_time)


def arrival_source(
    arrival: Column, gps_time: Column, system_time: Column, gps_label: str = "GPS", system_label: str = "Schedule"
) -> Column:
    return F.when(arrival == gps_time, gps_label).when(arrival == system_time, system_label)


def in_window(delay: Column, cutoffs: Cutoffs) -> Column:
    """Whether a delay lies strictly between the cutoffs; null without a delay."""
    return _strictly_between(delay, cutoffs.lowest, cutoffs.highest)


def trip_category(excluded: Column, uncovered: Column, arrival_in_window: Column, delay: Column) -> Column:
    return (
        F.when(excluded, "Excluded")
        .when(uncovered, "Uncovered")
        .when(~arrival_in_window, "Arrived outside window")
        .when(delay.isNotNull(), "Reported")
        .when(delay.isNull(), "Unreported")
        .otherwise("Unknown")
    )


def on_time_flag(uncovered: Column, delay: Column, limit: int) -> Column:
    """0 for uncovered or late trips, 1 for others, null where that is unknown."""
    late = uncovered | (delay > limit)
    return F.when(late, 0.0).when(~late, 1.0)


def time_tier(minutes: Column) -> Column:
    tier = F.when(F.lit(False), "")
    for limit, name in TIME_TIERS:
        tier = tier.when(minutes < limit, name)
    return tier.otherwise("")


def yard_code(garage: Column) -> Column:
    code = F.when(F.lit(False), "")
    for name, short in YARD_CODES.items():
        code = code.when(garage == name, short)
    return code


def direction_code(anchor_time_at_origin: Column) -> Column:
    """N is inbound, Y is outbound."""
    return F.when(anchor_time_at_origin == "N", "I").when(anchor_time_at_origin == "Y", "O")
