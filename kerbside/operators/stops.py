"""Stops of the routes of a plan snapshot, and what changed between two snapshots."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions.text import stop_text, text_or_na
from kerbside.operators.joins import distinct_by, join_on, never_null
from kerbside.schemas import PLAN_ROUTE, POINT, REQUEST, ROUTE_DETAIL, ROUTE_SET, SATISFACTION, VEHICLE
from kerbside.session import staged


@dataclass
class Snapshot:
    """Tables of one route plan; see ``kerbside.schemas`` for their columns."""

    routes: DataFrame
    route_sets: DataFrame
    vehicles: DataFrame
    details: DataFrame
    requests: DataFrame
    satisfactions: DataFrame
    points: DataFrame
    stored: StoredStops | None = None


@dataclass
class StoredStops:
    """What ``store_stops`` has kept of a snapshot: requests, and the stops that serve them, in buckets by request."""

    requests: DataFrame
    served: DataFrame


def enrich_routes(snapshot: Snapshot) -> DataFrame:
    """Routes with vehicle, yard and set name."""
    vehicles = VEHICLE.select_from(snapshot.vehicles).withColumnsRenamed({"overnight_garage": "yard"})
    sets = ROUTE_SET.select_from(snapshot.route_sets).withColumnsRenamed({"route_set_name": "route_set"})
    with_vehicle = join_on(
        PLAN_ROUTE.select_from(snapshot.routes), vehicles, null_safe=[("vehicle_id", "record_id")]
    )
    return join_on(with_vehicle, sets, null_safe=["route_set_id"])


def point_texts(points: DataFrame) -> DataFrame:
    return POINT.select_from(points).select(
        "record_id", stop_text(F.col("custom_description"), F.col("description")).alias("stop_description")
    )


def _when_type(inbound: Column, outbound: Column, other: Column | None = None) -> Column:
    chosen = F.when(F.col("request_type") == "I", inbound).when(F.col("request_type") == "O", outbound)
    return chosen if other is None else chosen.otherwise(other)


def _with_ends(requests: DataFrame) -> DataFrame:
    """Requests with the end of their route put in.

    The input has the request's own points and those of its route (``route_origin``, ``route_destination``). Inbound
    requests end where the route ends, outbound ones start where it starts.
    """
    own_origin, own_destination = F.col("origin_point_id"), F.col("destination_point_id")
    ends = requests.withColumns(
        {
            "origin_point_id": _when_type(own_origin, F.col("route_origin"), own_origin),
            "destination_point_id": _when_type(F.col("route_destination"), own_destination, own_destination),
        }
    )
    return ends.drop("route_origin", "route_destination")


def _with_anchors(requests: DataFrame) -> DataFrame:
    return requests.withColumns(
        {
            "anchor_point": _when_type(F.col("destination_point_id"), F.col("origin_point_id")),
            "non_anchor_point": _when_type(F.col("origin_point_id"), F.col("destination_point_id")),
        }
    )


def request_points(requests: DataFrame) -> DataFrame:
    """Distinct requests with the end of their route put in, and their anchor and other point."""
    return _with_anchors(_with_ends(requests).distinct())


ROUTE_KEY, STOP_KEY, REQUEST_KEY = ([name, f"{name}_none"] for name in ("route_key", "stop_key", "request_key"))


def served_requests(snapshot: Snapshot, staging: str | None = None) -> DataFrame:
    """Distinct (request key, route key) of the requests that a pick-up stop of a route satisfies.

    Stops are dealt by the key of their join and reduced to distinct rows there, so that copies do not multiply, and what
    they serve by its request, where the requests join it. Rows hold keys alone: what is known of a route is joined to the
    stops that are found.
    """
    details = ROUTE_DETAIL.select_from(snapshot.details)
    details = details.select(*_keys("record_id", "stop_key"), *_keys("route_id", "route_key"))
    satisfactions = SATISFACTION.select_from(snapshot.satisfactions)
    satisfactions = satisfactions.select(
        *_keys("trex_id", "request_key"), *_keys("pickup_route_detail_id", "stop_key")
    )
    served = join_on(satisfactions, distinct_by(details, STOP_KEY), plain=STOP_KEY, how="inner").drop(*STOP_KEY)
    return distinct_by(staged(served, staging), REQUEST_KEY)


def _keys(column: str, name: str) -> list[Column]:
    return [c.alias(n) for n, c in never_null(column, name).items()]


def _keyed_requests(snapshot: Snapshot) -> DataFrame:
    requests = REQUEST.select_from(snapshot.requests)
    return requests.withColumns(never_null("record_id", "request_key")).drop("record_id")


def _without_replaced_ends(requests: DataFrame) -> DataFrame:
    """The end that the route's takes the place of is left empty, which makes narrower rows."""
    none = F.lit(None).cast("bigint")
    origin, destination = F.col("origin_point_id"), F.col("destination_point_id")
    return requests.withColumns(
        {
            "origin_point_id": _when_type(origin, none, origin),
            "destination_point_id": _when_type(none, destination, destination),
        }
    )


def store_stops(snapshot: Snapshot, name: str, buckets: int, folder: str | None = None) -> Snapshot:
    """The snapshot with its requests and what serves them stored in ``buckets`` by request, as the tables
    ``name``_requests and ``name``_served, in ``folder`` or the warehouse.

    A plan is compared with several others; each comparison then joins bucket by bucket, without a shuffle. Every bucket
    is written by one task, so choose as many that one fits in a task.
    """
    spark = snapshot.requests.sparkSession
    tables = {"requests": _keyed_requests(snapshot), "served": served_requests(snapshot)}
    for part, rows in tables.items():
        writer = rows.repartition(buckets, *REQUEST_KEY).write.bucketBy(buckets, *REQUEST_KEY).sortBy(*REQUEST_KEY)
        if folder:
            writer = writer.option("path", f"{folder.rstrip('/')}/{name}_{part}")
        writer.mode("errorifexists").saveAsTable(f"{name}_{part}")
    return replace(snapshot, stored=StoredStops(*[spark.table(f"{name}_{part}") for part in tables]))


def _stop_rows(snapshot: Snapshot, staging: str | None = None) -> DataFrame:
    """(route, request type, points) of the requests that a pick-up stop satisfies; rows may repeat."""
    stored = snapshot.stored or StoredStops(_keyed_requests(snapshot), served_requests(snapshot, staging))
    requests = _without_replaced_ends(stored.requests)
    joined = join_on(requests, stored.served, plain=REQUEST_KEY, how="inner").drop(*REQUEST_KEY)
    routes = PLAN_ROUTE.select_from(snapshot.routes).select(
        *_keys("record_id", "route_key"),
        "visible_route_id",
        F.col("origin_point_id").alias("route_origin"),
        F.col("destination_point_id").alias("route_destination"),
    )
    found = join_on(joined, distinct_by(routes, ROUTE_KEY), plain=ROUTE_KEY).drop(*ROUTE_KEY)
    return _with_ends(found)


def snapshot_stops(snapshot: Snapshot) -> DataFrame:
    """Distinct (route, request type, points) of the requests that a pick-up stop satisfies."""
    rows = _stop_rows(snapshot)
    return _with_anchors(distinct_by(rows, rows.columns))


def stop_requests(snapshot: Snapshot) -> DataFrame:
    """The stops of a snapshot with the text of the point that is not the anchor."""
    return join_on(
        snapshot_stops(snapshot), point_texts(snapshot.points), null_safe=[("non_anchor_point", "record_id")]
    )


def stop_presence(pending: Snapshot, plan: Snapshot, staging: str | None = None) -> DataFrame:
    """Per route and stop point the number of stop rows in each snapshot.

    The snapshots are counted side by side rather than joined, so routes with many rows at a point give no pairs. With
    ``staging``, a shared folder, the rows of one snapshot are written there before the other's are made, and what serves
    its requests before that.
    """
    both = _with_anchors(both_sides(*[staged(_stop_rows(s, staging), staging) for s in (pending, plan)]))
    # The point of the count is one of the ends, and the anchor the other: what follows from it is left out of the rows.
    none = F.lit(None).cast("bigint")
    origin, destination = F.col("origin_point_id"), F.col("destination_point_id")
    both = both.select(
        "visible_route_id",
        "non_anchor_point",
        "request_type",
        "in_plan",
        _when_type(none, origin, origin).alias("origin_point_id"),
        _when_type(destination, none, destination).alias("destination_point_id"),
    )
    # Dealt by the key of the count, so that the distinct rows and their count share one shuffle, and counted in the order
    # that the distinct rows have: the last row of a place knows its numbers.
    place = ["visible_route_id", "non_anchor_point"]
    in_order = Window.partitionBy(*place).orderBy("request_type", "in_plan", "origin_point_id", "destination_point_id")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = distinct_by(both, place).select(
        *place,
        F.count_if(~F.col("in_plan")).over(so_far).alias("n_pending"),
        F.count_if("in_plan").over(so_far).alias("n_planning"),
        F.lead(F.lit(True)).over(in_order).isNull().alias("last"),
    )
    return counted.filter("last").drop("last")


def both_sides(pending: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows of both snapshots with the flag ``in_plan``."""
    return pending.withColumn("in_plan", F.lit(False)).unionByName(plan.withColumn("in_plan", F.lit(True)))


def stop_changes(pending: Snapshot, plan: Snapshot, staging: str | None = None) -> DataFrame:
    """Per route with changes: texts and numbers of the stops that are in one snapshot only.

    Removed stops have the text of the pending snapshot, added ones that of the plan. Equal texts of a route are counted
    before they are listed, so the list holds each text once.
    """
    changed = stop_presence(pending, plan, staging).filter((F.col("n_pending") == 0) | (F.col("n_planning") == 0))
    changed = changed.withColumn("in_plan", F.col("n_pending") == 0)
    texts = both_sides(point_texts(pending.points), point_texts(plan.points))
    described = join_on(changed, texts, null_safe=[("non_anchor_point", "record_id")], plain=["in_plan"])
    described = described.groupBy("visible_route_id", text_or_na(F.col("stop_description")).alias("text"))
    counted = described.agg(F.sum("n_pending").alias("n_removed"), F.sum("n_planning").alias("n_added"))

    def listed(count: str) -> Column:
        entries = F.array_sort(F.collect_list(F.when(F.col(count) > 0, F.struct("text", F.col(count).alias("n")))))
        copies = F.transform(entries, lambda e: F.array_repeat(e["text"], e["n"].cast("int")))
        return F.array_join(F.flatten(copies), " :: ")

    return counted.groupBy("visible_route_id").agg(
        listed("n_removed").alias("stops_removed"),
        listed("n_added").alias("stops_added"),
        F.sum("n_removed").cast("int").alias("n_stops_removed"),
        F.sum("n_added").cast("int").alias("n_stops_added"),
        F.sum(F.col("n_removed") + F.col("n_added")).cast("int").alias("n_stops_changed"),
    )
