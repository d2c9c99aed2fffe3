"""The on-time report: one row per route, date and direction with the arrival that counts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions import rules
from kerbside.functions.rules import Cutoffs
from kerbside.functions.text import garage_short, squish_strings
from kerbside.functions.times import delay_minutes
from kerbside.operators.buildings import anchored_buildings, zone_anchors
from kerbside.operators.joins import join_on, with_membership
from kerbside.operators.trips import Day, clean_trips, in_days, name_routes, one_of_each, scan_trips, service_range
from kerbside.operators.uncovered import attach_uncovered
from kerbside.operators.visits import (
    HALF_DAY,
    clock_minutes_apart,
    micros_apart,
    nearest_visits,
    prepare_visits,
    service_windows,
)
from kerbside.schemas import VEHICLE_OVERRIDE
from kerbside.session import staged

REPORT_COLUMNS = [
    "rp_vehicle", "rp_route", "expected_time", "arrival", "delay_combined", "actual_time", "gps_time", "delay_time",
    "gps_delay", "direction", "anchor_abbrev", "date", "ampm", "overnight_garage", "names", "route_name",
    "actual_load", "days", "route_set_name", "excluded", "original_rp_vehicle", "zone", "gps_category",
    "gps_duration", "in_gps", "in_system", "arrival_source", "arrival_in_window", "zone_known", "vehicle_override",
    "uncovered", "cutoff_min", "cutoff_max", "trip_category",
]


@dataclass
class OnTimeTables:
    """Inputs of the report; see ``kerbside.schemas`` for their columns.

    ``visits_dated_by`` names a column of the visits with the date of ``time_in``, if they are stored by one
    (``write_visits``): only the dates of the report are then read.
    """

    trips: DataFrame
    routes: DataFrame
    route_sets: DataFrame
    buildings: DataFrame
    zones: DataFrame
    visits: DataFrame
    overrides: DataFrame
    uncovered: DataFrame
    location_schedule: DataFrame
    visits_dated_by: str | None = None


def original_vehicles(
    overrides: DataFrame, first_day: Day | None = None, last_day: Day | None = None
) -> DataFrame:
    """Vehicle overrides of the asked days, cleaned, without copies."""
    return in_days(
        squish_strings(VEHICLE_OVERRIDE.select_from(overrides)), "effective_date", first_day, last_day
    ).distinct()


def attach_override(trips: DataFrame, overrides: DataFrame) -> DataFrame:
    """Trips with the flag ``vehicle_override`` and the original vehicle, which defaults to the vehicle itself."""
    keys = ["rp_route", "rp_vehicle", "effective_date"]
    joined = join_on(trips, overrides, null_safe=keys[:2], plain=keys[2:])
    original = F.col("original_rp_vehicle")
    return joined.withColumns(
        {
            "vehicle_override": original.isNotNull(),
            "original_rp_vehicle": F.coalesce(original, F.col("rp_vehicle")),
        }
    )


def choose_arrivals(candidates: DataFrame, cutoffs: Cutoffs, gps_label: str, system_label: str) -> DataFrame:
    """Candidates with the chosen arrival, its source, delay and whether it falls in the window."""
    gps, system = F.col("gps_time"), F.col("actual_time")
    arrival = rules.choose_arrival(F.col("gps_delay"), F.col("delay_time"), gps, system, cutoffs)
    return (
        candidates.withColumn("arrival", arrival)
        .withColumns(
            {
                "in_gps": gps.isNotNull(),
                "in_system": system.isNotNull(),
                "arrival_source": rules.arrival_source(F.col("arrival"), gps, system, gps_label, system_label),
                "delay_combined": delay_minutes(F.col("expected_time"), F.col("arrival")),
            }
        )
        .withColumn("arrival_in_window", rules.in_window(F.col("delay_combined"), cutoffs))
    )


def one_per_route(candidates: DataFrame, prefer_not_early: bool = False) -> DataFrame:
    """The best candidate of each route, date and direction.

    Early arrivals come first unless ``prefer_not_early`` is set, then those in the window, then small delays. The
    rest of the order makes the pick repeatable: arrival nearest to the planned clock minute, then nearest to the
    planned time, then earliest; vehicle, anchor, zone and planned time; the same for the GPS visit; all other columns.
    The rank limit is applied before the shuffle, so a route that holds a large part of all rows sends one row per map
    task.
    """
    delay = F.col("delay_combined")
    not_early = delay > rules.EARLY_LIMIT

    def nearness(ts: str) -> list[Column]:
        return [clock_minutes_apart(ts), micros_apart(ts), F.col(ts)]

    ties = [
        *nearness("arrival"),
        *[F.col(c) for c in ("rp_vehicle", "anchor_abbrev", "zone", "expected_time")],
        *nearness("gps_time"),
        *[
            F.col(c)
            for c in (
                "gps_category", "gps_duration", "actual_time", "delay_time", "overnight_garage", "route_set_name",
                "route_name", "actual_load", "days",
            )
        ],
    ]
    order = [
        not_early.desc_nulls_last() if prefer_not_early else not_early.asc_nulls_last(),
        F.col("arrival_in_window").desc_nulls_last(),
        F.abs(delay).asc_nulls_last(),
        *[c.asc_nulls_last() for c in ties],
    ]
    pick = F.row_number().over(Window.partitionBy("rp_route", *HALF_DAY).orderBy(*order))
    return candidates.withColumn("__pick", pick).filter(F.col("__pick") == 1).drop("__pick")


def on_time_candidates(
    trips: DataFrame, closest: DataFrame, cutoffs: Cutoffs, gps_label: str, system_label: str
) -> DataFrame:
    """Cleaned trips with each of their closest visits. Visits stem from these trips, so a left join keeps them all."""
    safe = ["rp_vehicle", "anchor_abbrev", "rp_route", "expected_time"]
    joined = join_on(trips, closest, null_safe=safe, plain=HALF_DAY)
    return choose_arrivals(joined, cutoffs, gps_label, system_label)


def otp_report(
    tables: OnTimeTables,
    first_day: Day | None = None,
    last_day: Day | None = None,
    half_days: tuple[str, ...] = ("AM", "PM"),
    include_visits: bool = True,
    cutoffs: Cutoffs = Cutoffs(),
    as_of: dt.datetime | None = None,
    prefer_not_early: bool = False,
    gps_label: str = "GPS",
    system_label: str = "Schedule",
    keep_listed: bool = False,
    staging: str | None = None,
) -> DataFrame:
    """On-time report over a range of days.

    Many days and both half-days are one plan; date and direction are part of every key, so the result is that of one
    run per day and half-day. ``include_visits=False`` rests on the schedule system alone. ``keep_listed`` adds the
    column ``listed_uncovered`` for ``covered_trips``. Visits are read once; the cleaned trips are used four times, from
    one shuffle that the branches share, or from ``staging``, a shared folder where they are written while the plan is
    built. A range of days bounds the scans of trips, schedule and visits; for an open end the first or last date is read
    from the trips.
    """
    anchored = anchored_buildings(tables.buildings)
    scanned = scan_trips(tables.trips, half_days, first_day, last_day)
    trips = clean_trips(
        scanned,
        tables.location_schedule,
        anchored,
        name_routes(tables.routes, tables.route_sets),
        first_day,
        last_day,
    )
    trips = staged(trips, staging) if staging else one_of_each(trips)

    span = service_range(scanned, first_day, last_day) if include_visits else None
    visits = tables.visits if span else tables.visits.filter(F.lit(False))
    windows = service_windows(trips, as_of)
    placed = prepare_visits(visits, tables.zones, anchored, windows, span, as_of, tables.visits_dated_by)
    nearest = nearest_visits(trips, placed)
    best = one_per_route(on_time_candidates(trips, nearest, cutoffs, gps_label, system_label), prefer_not_early)

    # One original vehicle per picked row, the first in text order: the pick has one row per route and day.
    overrides = original_vehicles(tables.overrides, first_day, last_day)
    first_override = overrides.groupBy("rp_route", "rp_vehicle", "effective_date").agg(
        F.min("original_rp_vehicle").alias("original_rp_vehicle")
    )
    listed = attach_uncovered(attach_override(best, first_override), tables.uncovered)
    known = with_membership(listed, "anchor_abbrev", zone_anchors(tables.zones, anchored), "anchor_abbrev", "zone_known")

    report = finish_report(known, cutoffs)
    return report.select(*REPORT_COLUMNS, *(["listed_uncovered"] if keep_listed else []))


def finish_report(listed: DataFrame, cutoffs: Cutoffs) -> DataFrame:
    """Drop the uncovered flag of trips that arrived and put every trip in its category."""
    arrived = F.col("in_system") | F.col("in_gps")
    return (
        listed.withColumnsRenamed({"uncovered": "listed_uncovered", "effective_date": "date"})
        .withColumns(
            {
                "overnight_garage": garage_short(F.col("overnight_garage")),
                "uncovered": F.col("listed_uncovered") & ~arrived,
                "cutoff_min": F.lit(float(cutoffs.lowest)),
                "cutoff_max": F.lit(float(cutoffs.highest)),
            }
        )
        .withColumn(
            "trip_category",
            rules.trip_category(
                F.col("excluded"), F.col("uncovered"), F.col("arrival_in_window"), F.col("delay_combined")
            ),
        )
    )


def covered_trips(report: DataFrame) -> DataFrame:
    """Trips of a report made with ``keep_listed`` that are listed as uncovered and arrived nevertheless."""
    return report.filter(F.col("listed_uncovered") & (F.col("in_system") | F.col("in_gps")))


def unreported_trips(report: DataFrame) -> DataFrame:
    """Trips that are excluded, or have no delay and are not listed as uncovered."""
    return report.filter(F.col("excluded") | (F.col("delay_combined").isNull() & ~F.col("uncovered")))


def vendor_names(report: DataFrame, gps: str, system: str) -> DataFrame:
    """The report under its published headings; the names of the GPS and schedule systems are part of some."""
    headings = {
        "rp_vehicle": "RPVehicle", "rp_route": "RPRoute", "expected_time": "ExpectedTime", "arrival": "Arrival",
        "delay_combined": "DelayTimeCombined", "actual_time": "ActualTime", "gps_time": f"{gps}ActualTime",
        "delay_time": "DelayTime", "gps_delay": f"{gps}DelayTime", "direction": "Direction",
        "anchor_abbrev": "AnchorAbbrev", "date": "Date", "ampm": "AMPM", "overnight_garage": "OvernightGarage",
        "names": "Names", "route_name": "RouteName", "actual_load": "ActualLoad", "days": "Days",
        "route_set_name": "RouteSetName", "excluded": "excludedShuttlesEtc",
        "original_rp_vehicle": "OriginalRPVehicle", "zone": "Zone", "gps_category": f"{gps}Category",
        "gps_duration": f"{gps}Duration", "in_gps": f"In{gps}", "in_system": f"In{system}",
        "arrival_source": "ArrivalTimeSource", "arrival_in_window": "ArrivalInWindow", "zone_known": f"ZoneIn{gps}",
        "vehicle_override": "OSVehicleOverride", "uncovered": "Uncovered", "cutoff_min": "CutoffMin",
        "cutoff_max": "CutoffMax", "trip_category": "TripCategory",
    }
    return report.select(*[F.col(c).alias(headings[c]) for c in REPORT_COLUMNS])
