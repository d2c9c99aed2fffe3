"""Planned trips of the schedule system, up to the point where GPS visits are matched."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import rules
from kerbside.functions.text import ampm_of, squish_strings
from kerbside.functions.times import rebase_date
from kerbside.operators.buildings import building_names, resolve_anchor
from kerbside.operators.joins import join_on
from kerbside.schemas import LOCATION_SCHEDULE, ROUTE, ROUTE_SET, TRIP

Day = dt.date | str


def in_days(df: DataFrame, column: str, first_day: Day | None, last_day: Day | None) -> DataFrame:
    """Keep the dates from ``first_day`` to ``last_day``, an open end where one is None. Reaches the scan as a filter."""
    day = F.col(column)
    kept = df.filter(day.isNotNull())
    if first_day is not None:
        kept = kept.filter(day >= F.lit(str(first_day)).cast("date"))
    if last_day is not None:
        kept = kept.filter(day <= F.lit(str(last_day)).cast("date"))
    return kept


def scan_trips(
    trips: DataFrame,
    half_days: tuple[str, ...] = ("AM", "PM"),
    first_day: Day | None = None,
    last_day: Day | None = None,
) -> DataFrame:
    """Trips of the asked days and half-days."""
    codes = rules.directions_for(half_days)
    return in_days(TRIP.select_from(trips), "effective_date", first_day, last_day).filter(
        F.col("direction").isin(codes)
    )


def service_days(scanned: DataFrame, first_day: Day | None = None, last_day: Day | None = None) -> int:
    """Upper bound on the number of service dates: the length of ``service_range``."""
    span = service_range(scanned, first_day, last_day)
    return (span[1] - span[0]).days + 1 if span else 0


def service_range(
    scanned: DataFrame, first_day: Day | None = None, last_day: Day | None = None
) -> tuple[dt.date, dt.date] | None:
    """The first and the last service date: the asked ones, or those of the trips; None without trips.

    For an open range two values, the first and the last date, are read from the trips.
    """
    if first_day is None or last_day is None:
        span = scanned.agg(F.min("effective_date"), F.max("effective_date")).first()
        first_day, last_day = first_day or span[0], last_day or span[1]
    if first_day is None or last_day is None:
        return None
    return dt.date.fromisoformat(str(first_day)), dt.date.fromisoformat(str(last_day))


def apply_location_schedule(
    pm_trips: DataFrame,
    location_schedule: DataFrame,
    first_day: Day | None = None,
    last_day: Day | None = None,
) -> DataFrame:
    """Outbound trips with planned and actual time from the schedule by location; the delay stays that of the trip.

    Copies of a schedule row are dropped first, so that a group of copies cannot multiply with the trips. The asked days
    bound the scan of the schedule.
    """
    times = in_days(LOCATION_SCHEDULE.select_from(location_schedule), "effective_date", first_day, last_day).distinct()
    times = times.withColumnsRenamed({"planned_time": "expected_time"})
    return join_on(
        pm_trips.drop("expected_time", "actual_time"),
        times,
        null_safe=["rp_vehicle", "rp_route", "anchor_abbrev"],
        plain=["effective_date"],
    ).select(*pm_trips.columns)


def name_routes(routes: DataFrame, route_sets: DataFrame) -> DataFrame:
    """Routes with the name, half-day and exclusion flag that follow from their set."""
    named = join_on(
        squish_strings(ROUTE.select_from(routes)),
        squish_strings(ROUTE_SET.select_from(route_sets)),
        null_safe=["route_set_id"],
    )
    return named.select(
        "rp_route",
        "route_name",
        "actual_load",
        "days",
        "route_set_name",
        ampm_of(F.col("route_set_name")).alias("ampm"),
        rules.is_excluded(F.col("actual_load"), F.col("route_set_name")).alias("excluded"),
    )


def clean_trips(
    trips: DataFrame,
    location_schedule: DataFrame,
    anchored: DataFrame,
    named_routes: DataFrame,
    first_day: Day | None = None,
    last_day: Day | None = None,
) -> DataFrame:
    """Scanned trips with schedule times, cleaned texts, planned time on the service date, anchor, names and route.

    Inbound trips take no part in the join with the schedule, so they are not shuffled for it.
    """
    inbound = trips.filter(F.col("direction") == "I")
    outbound = trips.filter(F.col("direction") == "O")
    outbound = apply_location_schedule(outbound, location_schedule, first_day, last_day)
    # Scanned directions are codes. Left alone they stay known as not null, and joins on them add no filter.
    both = squish_strings(inbound.unionByName(outbound), keep=("direction",))
    dated = both.withColumn("expected_time", rebase_date(F.col("expected_time"), F.col("effective_date")))
    resolved = resolve_anchor(dated, anchored)
    named = join_on(resolved, building_names(anchored), null_safe=["anchor_abbrev"])
    routed = join_on(named, named_routes, null_safe=["rp_route"])
    # The flag is never null, also where a trip has no route row.
    return routed.withColumn("excluded", F.coalesce("excluded", F.lit(False)))


def one_of_each(df: DataFrame) -> DataFrame:
    """The rows of ``df`` without copies, in a form that all branches of a plan share.

    The filter on the number of copies keeps the aggregate from being merged with one above it or pruned, so that every
    branch over it has the same shuffle below, which Spark then runs once. Filters on single columns must not be put on
    it where that matters: they would move below the shuffle.
    """
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    return copies.filter(F.col("__copies") > 0).drop("__copies")
