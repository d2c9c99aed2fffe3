"""Every operator as a query over the given tables: name to a function of (session, folder of parquet files)."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import rules, times
from kerbside.functions.rules import Cutoffs
from kerbside.functions.text import ampm_of, garage_short, squish_strings
from kerbside.operators import buildings, history, reshape, stops, trips, uncovered, visits
from kerbside.operators.joins import join_on, with_membership
from kerbside.plans import daily_rates, on_time, trip_changes
from kerbside.plans.update import publish_update, update_history
from kerbside.schemas import ZONE_VISIT
from kerbside.session import checkpoint_folder, staged
from kerbside.sources.derived import derived
from kerbside.sources.published import publish, read_published
from kerbside.sources.tables import VISIT_DATE, write_visits

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


class Inputs:
    """The derived tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return derived(self._spark, self._dir, name)

    def base(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")

    def on_time(self) -> on_time.OnTimeTables:
        return on_time.OnTimeTables(
            trips=self.trip,
            routes=self.route,
            route_sets=self.route_set,
            buildings=self.building,
            zones=self.zone,
            visits=self.zone_visit,
            overrides=self.vehicle_override,
            uncovered=self.uncovered,
            location_schedule=self.location_schedule,
        )

    def snapshot(self, side: str) -> stops.Snapshot:
        return stops.Snapshot(
            routes=getattr(self, f"route_{side}"),
            route_sets=getattr(self, f"route_set_{side}"),
            vehicles=getattr(self, f"vehicle_{side}"),
            details=getattr(self, f"route_detail_{side}"),
            requests=getattr(self, f"request_{side}"),
            satisfactions=getattr(self, f"satisfaction_{side}"),
            points=getattr(self, f"point_{side}"),
        )

    def anchored(self) -> DataFrame:
        return buildings.anchored_buildings(self.building)

    def named_routes(self) -> DataFrame:
        return trips.name_routes(self.route, self.route_set)

    def clean_trips(self) -> DataFrame:
        return trips.clean_trips(
            trips.scan_trips(self.trip), self.location_schedule, self.anchored(), self.named_routes()
        )

    def settled_trips(self) -> DataFrame:
        """Cleaned trips for plans that read them more than once."""
        return staged(self.clean_trips(), self.staging)

    @property
    def staging(self) -> str | None:
        return checkpoint_folder(self._spark)

    def overridden_trips(self) -> DataFrame:
        return on_time.attach_override(trips.scan_trips(self.trip), on_time.original_vehicles(self.vehicle_override))

    def placed_visits(self, clean: DataFrame) -> DataFrame:
        span = trips.service_range(trips.scan_trips(self.trip))
        windows = visits.service_windows(clean)
        return visits.prepare_visits(self.zone_visit, self.zone, self.anchored(), windows, span)

    @property
    def tables_folder(self) -> str:
        """A new folder for tables that a query writes: where the session stages, or in the warehouse."""
        base = self.staging or self._spark.conf.get("spark.sql.warehouse.dir")
        return f"{base.rstrip('/')}/kerbside-{uuid4().hex}"

    def report(self, **options) -> DataFrame:
        return on_time.otp_report(self.on_time(), staging=self.staging, **options)

    def both_plans(self) -> tuple[stops.Snapshot, stops.Snapshot]:
        return self.snapshot("pend"), self.snapshot("plan")


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


# Schedule system and small tables.


@query
def otp_scan(t: Inputs) -> DataFrame:
    return trips.scan_trips(t.trip, half_days=("AM",))


@query
def uncovered_norm(t: Inputs) -> DataFrame:
    return uncovered.normalise_uncovered(t.uncovered)


@query
def zone_categories(t: Inputs) -> DataFrame:
    return visits.zone_categories(t.zone)


@query
def squish(t: Inputs) -> DataFrame:
    return squish_strings(t.building)


@query
def building_anchor(t: Inputs) -> DataFrame:
    return t.anchored()


@query
def building_names(t: Inputs) -> DataFrame:
    return buildings.building_names(t.anchored())


@query
def expected_rebase(t: Inputs) -> DataFrame:
    rebased = times.rebase_date(F.col("expected_time"), F.col("effective_date"))
    return t.trip.select("rp_route", "rp_vehicle", "effective_date", "expected_time", rebased.alias("rebased_time"))


@query
def anchor_fallback(t: Inputs) -> DataFrame:
    columns = ["rp_route", "rp_vehicle", "effective_date", "anchor_abbrev"]
    return buildings.resolve_anchor(t.trip.select(*columns), t.anchored()).select(*columns)


@query
def ampm_extract(t: Inputs) -> DataFrame:
    return squish_strings(t.route_set).withColumn("ampm", ampm_of(F.col("route_set_name")))


@query
def exclusion_flag(t: Inputs) -> DataFrame:
    return t.named_routes().select("rp_route", "route_set_name", "actual_load", "excluded")


@query
def route_named(t: Inputs) -> DataFrame:
    columns = ["rp_route", "rp_vehicle", "effective_date", "direction"]
    return join_on(t.trip.select(*columns), t.named_routes().drop("excluded"), null_safe=["rp_route"])


@query
def delay_minutes(t: Inputs) -> DataFrame:
    delay = times.delay_minutes(F.col("expected_time"), F.col("actual_time"))
    return t.trip.select(
        "rp_route", "rp_vehicle", "effective_date", "expected_time", "actual_time", delay.alias("delay")
    )


@query
def garage_short_name(t: Inputs) -> DataFrame:
    garage = garage_short(F.col("overnight_garage"))
    return t.trip.select("rp_vehicle", "rp_route", "overnight_garage", garage.alias("garage"))


@query
def pm_schedule(t: Inputs) -> DataFrame:
    return trips.apply_location_schedule(trips.scan_trips(t.trip, half_days=("PM",)), t.location_schedule)


@query
def vehicle_override(t: Inputs) -> DataFrame:
    return t.overridden_trips()


@query
def uncovered_join(t: Inputs) -> DataFrame:
    named = join_on(t.overridden_trips(), t.named_routes(), null_safe=["rp_route"])
    return uncovered.attach_uncovered(named, t.uncovered).select(
        "rp_route", "rp_vehicle", "effective_date", "original_rp_vehicle", "ampm", "route_set_name", "uncovered"
    )


# GPS visits.


@query
def service_window(t: Inputs) -> DataFrame:
    return visits.service_windows(t.clean_trips())


@query
def zone_visits_window(t: Inputs) -> DataFrame:
    span = trips.service_range(trips.scan_trips(t.trip))
    if span is None:
        return visits.visits_in_windows(ZONE_VISIT.select_from(t.zone_visit), visits.service_windows(t.clean_trips()))
    near = visits.visits_near_days(ZONE_VISIT.select_from(t.zone_visit), span)
    kept = visits.drop_other_categories(near, t.zone)
    return visits.visits_in_windows(kept, visits.service_windows(t.clean_trips()), (span[1] - span[0]).days + 1)


@query
def zone_visits_dated(t: Inputs) -> DataFrame:
    """The visits stored by date, and those of them that start in a service window."""
    folder = t.tables_folder
    write_visits(t.zone_visit, folder)
    span = trips.service_range(trips.scan_trips(t.trip))
    typed = visits.typed_visits(t._spark.read.parquet(folder), VISIT_DATE)
    if span is not None:
        typed = visits.visits_near_days(typed, span, dated_by=VISIT_DATE)
    days = (span[1] - span[0]).days + 1 if span else None
    kept = visits.drop_other_categories(typed, t.zone)
    return visits.visits_in_windows(kept, visits.service_windows(t.clean_trips()), days, VISIT_DATE)


@query
def visit_anchor(t: Inputs) -> DataFrame:
    return visits.visit_anchors(ZONE_VISIT.select_from(t.zone_visit).distinct(), t.anchored())


@query
def zone_known(t: Inputs) -> DataFrame:
    anchors = buildings.zone_anchors(t.zone, t.anchored())
    columns = ["rp_route", "rp_vehicle", "effective_date", "direction", "anchor_abbrev"]
    return with_membership(t.clean_trips().select(*columns), "anchor_abbrev", anchors, "anchor_abbrev", "zone_known")


@query
def visit_match(t: Inputs) -> DataFrame:
    clean = t.settled_trips()
    return visits.match_visits(clean, t.placed_visits(clean)).drop("near")


@query
def closest_visit(t: Inputs) -> DataFrame:
    clean = t.settled_trips()
    return visits.closest_visits(clean, t.placed_visits(clean))


@query
def arrival_choice(t: Inputs) -> DataFrame:
    clean = t.settled_trips()
    closest = visits.closest_visits(clean, t.placed_visits(clean))
    return on_time.on_time_candidates(clean, closest, Cutoffs(), "GPS", "Schedule").select(
        "rp_route", "rp_vehicle", "anchor_abbrev", "effective_date", "direction", "expected_time", "zone", "gps_time",
        "gps_delay", "actual_time", "delay_time", "arrival", "arrival_source", "delay_combined", "arrival_in_window",
    )


# On-time report and what is made of it.


@query
def otp_report(t: Inputs) -> DataFrame:
    return t.report()


@query
def otp_no_visits(t: Inputs) -> DataFrame:
    return t.report(include_visits=False)


@query
def trip_category(t: Inputs) -> DataFrame:
    return t.report().select(
        "rp_route", "date", "direction", "original_rp_vehicle", "excluded", "uncovered", "delay_combined",
        "trip_category",
    )


@query
def covered_trips(t: Inputs) -> DataFrame:
    return on_time.covered_trips(t.report(keep_listed=True)).drop("listed_uncovered")


@query
def uncovered_reconcile(t: Inputs) -> DataFrame:
    return uncovered.flag_removable(t.uncovered, on_time.covered_trips(t.report(keep_listed=True)))


@query
def uncovered_reconcile_any(t: Inputs) -> DataFrame:
    return uncovered.flag_removable(t.uncovered, on_time.covered_trips(t.report(keep_listed=True)), match="any")


@query
def unreported_trips(t: Inputs) -> DataFrame:
    return on_time.unreported_trips(t.report())


@query
def lateness_flags(t: Inputs) -> DataFrame:
    flags = daily_rates.lateness_flags(F.col("uncovered"), F.col("delay_combined"))
    return (
        t.report()
        .select("rp_route", "date", "direction", "original_rp_vehicle", "uncovered", "delay_combined")
        .withColumns(flags)
    )


@query
def time_tier(t: Inputs) -> DataFrame:
    minutes = times.minutes_of_day(F.col("expected_time"), F.col("date"))
    planned = t.clean_trips().select("rp_route", "rp_vehicle", F.col("effective_date").alias("date"), "expected_time")
    return planned.withColumn("minutes", minutes).withColumn("time_tier", rules.time_tier(F.col("minutes")))


@query
def prepare_raw(t: Inputs) -> DataFrame:
    return daily_rates.prepare_raw(t.report())


@query
def prepare_raw_old(t: Inputs) -> DataFrame:
    return daily_rates.prepare_raw(t.report(), oldstyle=True)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("otp_date", *[F.round(c, 6).alias(c) for c in df.columns if c != "otp_date"])


@query
def otp_summary(t: Inputs) -> DataFrame:
    return _rounded(daily_rates.otp_summary(t.report()))


def _held_history(t: Inputs) -> DataFrame:
    measures = [c for c in daily_rates.RATE_HEADINGS if c != "otp_date"]
    return t.history.select("otp_date", *measures[:2], *[F.lit(None).cast("double").alias(c) for c in measures[2:]])


@query
def history_merge(t: Inputs) -> DataFrame:
    return _rounded(update_history(_held_history(t), t.report(), staging=t.staging))


@query
def history_published(t: Inputs) -> DataFrame:
    """The history published in a folder, updated there, and read as its readers find it."""
    folder = t.tables_folder
    publish(_held_history(t), folder)
    publish_update(folder, t.report())
    return _rounded(read_published(t._spark, folder))


def _two_level_history(t: Inputs) -> DataFrame:
    """The history as its sheet holds it: two rows of headings, joined to one."""
    published = list(daily_rates.RATE_HEADINGS.values())
    groups, names = zip(*[h.rsplit("_", 1) if "OTP_W" not in h else h.split("_", 1) for h in published], strict=True)
    above = [g if i == 0 or g != groups[i - 1] else None for i, g in enumerate(groups)]
    measures = [F.lit(None).cast("double").alias(f"m{i}") for i in range(len(published) - 3)]
    held = t.history.select("otp_date", "otp_am", "otp_pm", *measures)
    return held.toDF(*history.flat_headings(above, list(names)))


@query
def history_headings(t: Inputs) -> DataFrame:
    updated = update_history(_two_level_history(t), t.report(), staging=t.staging)
    return updated.select(
        "OTP_Date", *[F.round(history.quoted(c), 6).alias(c) for c in updated.columns if c != "OTP_Date"]
    )


@query
def fill_down(t: Inputs) -> DataFrame:
    events = t.base("events").select(
        "event_id",
        "user_id",
        "ts",
        F.when(F.col("event_type").isin("purchase", "signup"), F.col("event_type")).alias("mark"),
    )
    return history.fill_down(events, ["mark"], ["user_id"], ["ts", "event_id"], chunk=F.to_date("ts"))


# Route plans.


@query
def stop_text(t: Inputs) -> DataFrame:
    return stops.point_texts(t.point)


@query
def request_points(t: Inputs) -> DataFrame:
    return stops.snapshot_stops(t.snapshot("pend"))


@query
def route_enriched(t: Inputs) -> DataFrame:
    return stops.enrich_routes(t.snapshot("pend"))


@query
def route_anchor(t: Inputs) -> DataFrame:
    enriched = stops.enrich_routes(t.snapshot("pend"))
    return trip_changes.route_anchors(enriched, t.point_pend).select(
        "record_id", "visible_route_id", "anchor_time_at_origin", "anchor_point_id", "anchor_location"
    )


@query
def stop_requests(t: Inputs) -> DataFrame:
    return stops.stop_requests(t.snapshot("pend"))


@query
def stop_presence(t: Inputs) -> DataFrame:
    return stops.stop_presence(*t.both_plans())


@query
def stop_changes(t: Inputs) -> DataFrame:
    return stops.stop_changes(*t.both_plans())


@query
def stop_changes_stored(t: Inputs) -> DataFrame:
    """Both snapshots stored in buckets by request, then compared."""
    stored = []
    for snapshot in t.both_plans():
        folder = t.tables_folder
        stored.append(stops.store_stops(snapshot, folder.rsplit("/", 1)[1].replace("-", "_"), 8, folder))
    return stops.stop_changes(*stored)


def _old_rule(t: Inputs) -> DataFrame:
    return trip_changes.old_change_rule(*[stops.enrich_routes(s) for s in t.both_plans()])


@query
def old_change_rule(t: Inputs) -> DataFrame:
    return _old_rule(t)


@query
def in_old_rule(t: Inputs) -> DataFrame:
    routes = t.route_plan.select("visible_route_id", F.col("visible_route_id").try_cast("bigint").alias("number"))
    return with_membership(routes, "number", _old_rule(t), "route", "in_old_rule").drop("number")


@query
def route_diff(t: Inputs) -> DataFrame:
    return trip_changes.route_diff(*t.both_plans(), staging=t.staging)


_FIXED = trip_changes.Fixes(anchor=True, direction=True, any_change="abs")


@query
def route_diff_fixed(t: Inputs) -> DataFrame:
    return trip_changes.route_diff(*t.both_plans(), fixes=_FIXED, staging=t.staging)


@query
def change_long(t: Inputs) -> DataFrame:
    return trip_changes.change_long(trip_changes.route_diff(*t.both_plans(), staging=t.staging))


@query
def change_notes(t: Inputs) -> DataFrame:
    return trip_changes.change_notes(trip_changes.change_long(trip_changes.route_diff(*t.both_plans(), staging=t.staging)))


@query
def tripchange_report(t: Inputs) -> DataFrame:
    return trip_changes.tripchange_report(*t.both_plans(), staging=t.staging)


@query
def tripchange_fixed(t: Inputs) -> DataFrame:
    return trip_changes.tripchange_report(*t.both_plans(), fixes=_FIXED, staging=t.staging)


# Student monitor.


@query
def monitor_wide(t: Inputs) -> DataFrame:
    return reshape.monitor_wide(t.monitor)


@query
def monitor_long(t: Inputs) -> DataFrame:
    return reshape.monitor_long(reshape.monitor_wide(t.monitor))


QUERIES["garage_short"] = QUERIES.pop("garage_short_name")
