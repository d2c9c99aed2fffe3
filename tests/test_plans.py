"""Plans on stored tables: what is read and shuffled, and that other storage gives the same rows."""

import datetime as dt
from collections import Counter
from dataclasses import fields, replace
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from kerbside.catalog.queries import Inputs
from kerbside.operators import visits
from kerbside.operators.buildings import anchored_buildings
from kerbside.operators.joins import distinct_by
from kerbside.operators.reshape import monitor_long, monitor_wide
from kerbside.operators.stops import Snapshot, snapshot_stops, stop_changes, stop_presence, store_stops
from kerbside.operators.trips import clean_trips, name_routes, scan_trips
from kerbside.plans.on_time import OnTimeTables, otp_report
from kerbside.plans.trip_changes import route_diff, tripchange_report
from kerbside.sources.tables import VISIT_DATE, write_visits

SF_DIR = "/root/testdata/sf0.001"


def rows(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def stored(spark, tables, folder):
    """The same tables from files."""
    names = [f.name for f in fields(tables) if getattr(tables, f.name) is not None]
    for name in names:
        getattr(tables, name).write.parquet(f"{folder}/{name}")
    return replace(tables, **{name: spark.read.parquet(f"{folder}/{name}") for name in names})


@pytest.fixture(scope="module")
def on_time(spark, tmp_path_factory):
    tables = Inputs(spark, SF_DIR).on_time()
    return stored(spark, tables, tmp_path_factory.mktemp("on_time"))


@pytest.fixture(scope="module")
def snapshots(spark, tmp_path_factory):
    return [stored(spark, s, tmp_path_factory.mktemp("plan")) for s in Inputs(spark, SF_DIR).both_plans()]


@pytest.fixture()
def shuffled(spark):
    """Every join by a shuffle, as between large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final(df) -> str:
    """The plan that was run."""
    df.collect()
    return planned(df).split("== Initial Plan ==")[0]


def hash_shuffles(plan: str) -> int:
    return plan.count("Exchange hashpartitioning")


def scans(plan: str, name: str) -> int:
    return sum("FileScan" in line and f"/{name}]" in line for line in plan.splitlines())


def cleaned(t: OnTimeTables):
    anchored = anchored_buildings(t.buildings)
    return clean_trips(scan_trips(t.trips), t.location_schedule, anchored, name_routes(t.routes, t.route_sets))


def placed(t: OnTimeTables, trips):
    return visits.prepare_visits(t.visits, t.zones, anchored_buildings(t.buildings), visits.service_windows(trips))


def test_visit_match_reads_visits_once(spark, on_time, tmp_path):
    cleaned(on_time).write.parquet(f"{tmp_path}/trips")
    trips = spark.read.parquet(f"{tmp_path}/trips")
    for find in (visits.match_visits, visits.closest_visits, visits.nearest_visits):
        plan = planned(find(trips, placed(on_time, trips)))
        assert scans(plan, "visits") == 1
        assert hash_shuffles(plan) <= 12


def test_visit_match_by_shuffles_alone(spark, on_time, shuffled):
    trips = cleaned(on_time)
    plan = planned(visits.match_visits(trips, placed(on_time, trips)))
    assert scans(plan, "visits") == 1


def test_report_reads_visits_once_and_cleans_trips_once(on_time):
    plan = final(otp_report(on_time))
    assert scans(plan, "visits") == 1
    # Inbound and outbound trips; all other branches use the shuffle above them.
    assert scans(plan, "trips") == 2
    assert plan.count("ReusedExchange") >= 3


def test_visits_stored_by_date_are_pruned(spark, on_time, tmp_path):
    write_visits(on_time.visits, f"{tmp_path}/dated")
    dated = replace(on_time, visits=spark.read.parquet(f"{tmp_path}/dated"), visits_dated_by=VISIT_DATE)
    assert rows(otp_report(dated)) == rows(otp_report(on_time))

    windows = visits.service_windows(scan_trips(on_time.trips).withColumn("excluded", F.lit(False)))
    two = windows.filter("day(effective_date) IN (2, 5)")
    found = visits.visits_in_windows(visits.typed_visits(dated.visits, VISIT_DATE), two, 60, VISIT_DATE)
    assert "dynamicpruning" in planned(found)
    plain = visits.visits_in_windows(visits.typed_visits(on_time.visits), two, 60)
    assert rows(found) == rows(plain) and found.columns == plain.columns and found.count() > 0

    day = dt.date.fromisoformat(str(on_time.trips.agg(F.min("effective_date")).first()[0]))
    one_day = otp_report(dated, day, day)
    listed = [line for line in planned(one_day).splitlines() if "PartitionFilters" in line and VISIT_DATE in line]
    assert listed and all(f"({VISIT_DATE}" in line and "<=" in line and ">=" in line for line in listed)


def test_spots_of_an_hour_are_few_and_spread_a_busy_vehicle(spark):
    """One vehicle, anchor and half-day with a visit every ten seconds and a trip every minute."""
    day, start = dt.date(2024, 3, 1), dt.datetime(2024, 3, 1, 5)
    seen = [("B", "A", "Z", day, "I", start + dt.timedelta(seconds=10 * i), "c", 1.0) for i in range(2520)]
    asked = spark.createDataFrame(
        [("=B", "=A", day, "I", list(range(4, 15)))],
        "rp_vehicle_key string, anchor_abbrev_key string, effective_date date, direction string, hours array<bigint>",
    )
    placed_visits = spark.createDataFrame(
        seen,
        "rp_vehicle string, anchor_abbrev string, zone string, effective_date date, direction string, "
        "gps_time timestamp_ntz, gps_category string, gps_duration double",
    )
    for minutes in (visits.minutes_with_visits(placed_visits), visits.minutes_with_every_visit(placed_visits)):
        found = visits.spots_by_hour(minutes, asked).select("hour", F.size("spots").alias("n"), "n_visits").collect()
        # Before and after the visits the nearest two minutes are carried, between them an hour and two on either side.
        assert {r.hour: r.n for r in found} == {4: 2, 5: 62, 11: 62, 12: 2, 13: 2, 14: 2, **dict.fromkeys(range(6, 11), 64)}
        assert {r.n_visits for r in found} == {2520}


def test_copies_of_a_visit_are_given_back_in_blocks(spark):
    n = F.lit(2 * visits.COPIES + 5)
    blocks = spark.range(1).select(visits._times(n).alias("b")).first().b
    assert blocks == [visits.COPIES, visits.COPIES, 5]
    assert spark.range(1).select(visits._times(F.lit(1)).alias("b")).first().b == [1]


def test_plan_comparison_shuffles(snapshots, shuffled):
    assert hash_shuffles(planned(stop_changes(*snapshots))) <= 20
    assert hash_shuffles(planned(tripchange_report(*snapshots))) <= 42


def test_stored_stops_need_no_shuffle_below_the_request_join(spark, snapshots, shuffled, tmp_path):
    kept = [store_stops(s, f"stops_{uuid4().hex}", 4, tmp_path.as_uri()) for s in snapshots]
    plan = planned(stop_changes(*kept))
    lines = plan.splitlines()
    joins = [i for i, line in enumerate(lines) if "SortMergeJoin [request_key" in line]
    assert len(joins) == 2
    for i in joins:
        depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
        below = []
        for line in lines[i + 1 :]:
            if len(line) - len(line.lstrip(" :+-")) <= depth:
                break
            below.append(line)
        assert below and not any("Exchange" in line for line in below)
        assert any("Bucketed: true" in line for line in below)
    assert rows(stop_changes(*kept)) == rows(stop_changes(*snapshots))
    assert rows(route_diff(*kept)) == rows(route_diff(*snapshots))


def test_missing_and_repeated_ids_in_stops(spark, shuffled, tmp_path):
    """Missing ids meet missing ids, copies count once, in plain and in bucketed tables."""
    def side(shift: int) -> Snapshot:
        return Snapshot(
            routes=spark.createDataFrame(
                [(i, str(i), 1, 1, "n", 1, 1, 1, 1.0, 1, "M", "Y", 100 + i, 200 + i) for i in (1, 2)] * 3
                + [(None, "none", 1, 1, "n", 1, 1, 1, 1.0, 1, "M", "Y", 7, 8)],
                "record_id bigint, visible_route_id string, vehicle_id bigint, route_set_id bigint, name string, desired_load int, "
                "actual_load int, route_time_s int, route_distance double, anchor_time_s int, days string, "
                "anchor_time_at_origin string, origin_point_id bigint, destination_point_id bigint",
            ),
            route_sets=spark.createDataFrame([], "route_set_id bigint, route_set_name string"),
            vehicles=spark.createDataFrame([], "record_id bigint, vehicle string, overnight_garage string"),
            details=spark.createDataFrame(
                [(0, 1), (10, 1), (10, 1), (11, 2), (None, None), (12, 99), (None, 2)], "record_id bigint, route_id bigint"
            ),
            requests=spark.createDataFrame(
                [(20, "I", 50 + shift, 60), (20, "I", 50 + shift, 60), (21, "O", 51, 61), (None, "I", 52, 62), (0, "O", 53, 63)],
                "record_id bigint, request_type string, origin_point_id bigint, destination_point_id bigint",
            ),
            satisfactions=spark.createDataFrame(
                [(20, 10), (20, 10), (21, 11), (None, None), (0, 0), (20, 12)], "trex_id bigint, pickup_route_detail_id bigint"
            ),
            points=spark.createDataFrame([(50, "p", None), (51, None, "q")], "record_id bigint, description string, custom_description string"),
        )

    pending, plan = side(0), side(1)
    names = ["visible_route_id", "request_type", "origin_point_id", "destination_point_id", "anchor_point", "non_anchor_point"]
    stops = rows(snapshot_stops(pending).select(names))
    expected = {
        ("1", "I", 50, 201, 201, 50), ("2", "O", 102, 61, 102, 61), ("none", "I", 52, 8, 8, 52), ("2", "I", 52, 202, 202, 52),
        ("1", "O", 101, 63, 101, 63), (None, "I", 50, None, None, 50),
    }
    assert set(stops) == expected and set(stops.values()) == {1}
    kept = [store_stops(s, f"stops_{uuid4().hex}", 3, tmp_path.as_uri()) for s in (pending, plan)]
    assert rows(snapshot_stops(kept[0]).select(names)) == stops
    assert rows(stop_changes(*kept)) == rows(stop_changes(pending, plan))
    assert sorted(tuple(r) for r in stop_changes(pending, plan).fillna("-", ["visible_route_id"]).collect()) == [
        ("-", "p", "q", 1, 1, 2), ("1", "p", "q", 1, 1, 2),
    ]


def test_monitor_rows_are_dealt_before_they_are_sorted(spark, shuffled):
    long = spark.createDataFrame(
        [(i, "P", "M", "Pickup", f"R{i}", None) for i in range(3)],
        "record_id long, program_description string, day string, shift string, route string, bus string",
    )
    for wide in (monitor_wide(long), monitor_long(monitor_wide(long))):
        plan = planned(wide)
        assert hash_shuffles(plan) == 1 and "SortAggregate" not in plan.split("Exchange hashpartitioning", 1)[1]


def test_compared_routes_are_moved_by_id_once(snapshots, shuffled):
    """The rows of a side are wide, so neither their pairs nor the differences are dealt again."""
    plan = planned(route_diff(*snapshots))
    assert hash_shuffles(plan) <= 39
    # The last three joins, by id, follow each other without a shuffle between them.
    top = [line for line in plan.splitlines() if "SortMergeJoin" in line or "Exchange" in line][:3]
    assert all("SortMergeJoin [id_key" in line for line in top)


def test_stops_are_counted_in_few_shuffles(snapshots, shuffled):
    assert hash_shuffles(planned(stop_changes(*snapshots))) <= 17


def test_stops_are_counted_in_the_order_of_their_sort(snapshots, shuffled):
    """The count takes no memory beside the sorted rows."""
    plan = planned(stop_presence(*snapshots))
    assert "HashAggregate" not in plan[: plan.index("Union")]


def test_stops_are_counted_once_per_plan(snapshots):
    place = ["visible_route_id", "non_anchor_point"]
    sides = [snapshot_stops(s).groupBy(*place).count() for s in snapshots]
    expected = Counter()
    for side, found in enumerate(sides):
        for route, point, n in rows(found):
            expected[route, point, side] = n
    got = Counter({(r, p, side): n for r, p, *both in rows(stop_presence(*snapshots)) for side, n in enumerate(both) if n})
    assert got == expected


def test_distinct_rows_by_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, "a"), (None, "a"), (None, None), (1, "b")], "k long, v string")
    assert rows(distinct_by(df, ["k"])) == rows(df.distinct())
