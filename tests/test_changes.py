"""Differences between route plans on small plans."""

import dataclasses
import time

import pytest
from pyspark.sql import functions as F

from kerbside.operators.reshape import monitor_long, monitor_wide
from kerbside.operators.stops import Snapshot, enrich_routes, stop_changes, stop_presence
from kerbside.plans.trip_changes import (
    Fixes,
    Thresholds,
    change_long,
    change_notes,
    old_change_rule,
    published_changes,
    route_diff,
    tripchange_report,
)
from kerbside.session import SHUFFLE_CLEANUP, stage

ROUTES = (
    "record_id bigint, visible_route_id string, vehicle_id bigint, route_set_id bigint, name string, desired_load int, "
    "actual_load int, route_time_s int, route_distance double, anchor_time_s int, days string, "
    "anchor_time_at_origin string, origin_point_id bigint, destination_point_id bigint"
)
BASE = {
    "record_id": 1, "visible_route_id": "1", "vehicle_id": 10, "route_set_id": 20, "name": "N", "desired_load": 10,
    "actual_load": 10, "route_time_s": 1800, "route_distance": 500.0, "anchor_time_s": 25200, "days": "MTWHF",
    "anchor_time_at_origin": "Y", "origin_point_id": 100, "destination_point_id": 200,
}


def plan(spark, *routes, stops=(), vehicles=None, points=None) -> Snapshot:
    """``stops`` holds (route record id, request type, origin, destination)."""
    n = range(len(stops))
    vehicles = vehicles or [(10, "V10", "EAST"), (11, "V11", "EAST"), (12, "V12", "WEST"), (13, None, "WEST")]
    points = points or [
        (100, "Hundred", None), (200, "Two hundred", ""), (300, "Three", "Third"), (301, "Three", None), (302, None, None),
    ]
    return Snapshot(
        routes=spark.createDataFrame([{**BASE, **r} for r in routes], ROUTES),
        route_sets=spark.createDataFrame([(20, "SET 20"), (21, "SET 21")], "route_set_id bigint, route_set_name string"),
        vehicles=spark.createDataFrame(vehicles, "record_id bigint, vehicle string, overnight_garage string"),
        details=spark.createDataFrame([(i, s[0]) for i, s in zip(n, stops)], "record_id bigint, route_id bigint"),
        requests=spark.createDataFrame(
            [(1000 + i, *s[1:]) for i, s in zip(n, stops)],
            "record_id bigint, request_type string, origin_point_id bigint, destination_point_id bigint",
        ),
        satisfactions=spark.createDataFrame([(1000 + i, i) for i in n], "trex_id bigint, pickup_route_detail_id bigint"),
        points=spark.createDataFrame(points, "record_id bigint, description string, custom_description string"),
    )


def only(df):
    found = df.collect()
    assert len(found) == 1
    return found[0]


def test_a_plan_against_itself_has_no_changes(spark):
    same = plan(spark, {}, {"record_id": 2, "visible_route_id": None}, stops=[(1, "I", 300, 200), (2, "O", 100, 301)])
    assert stop_changes(same, same).count() == 0
    assert tripchange_report(same, same).count() == 0
    diffs = route_diff(same, same)
    assert diffs.count() == 2 and diffs.filter("any_change").count() == 0
    assert old_change_rule(enrich_routes(same), enrich_routes(same)).count() == 0


def test_swapping_plans_swaps_stops(spark):
    old = plan(spark, {}, stops=[(1, "I", 300, 200), (1, "I", 301, 200), (1, "I", 302, 200), (1, "X", 300, 200)])
    new = plan(spark, {}, stops=[(1, "I", 301, 200), (1, "O", 100, 300), (1, "O", 100, 200), (1, "X", 301, 5)])
    forth, back = only(stop_changes(old, new)), only(stop_changes(new, old))
    # The point 300 is a stop of both plans; the missing text is written NA; requests of other types have no stop.
    assert (forth.stops_removed, forth.stops_added) == ("NA", "Two hundred")
    assert (forth.n_stops_removed, forth.n_stops_added, forth.n_stops_changed) == (1, 1, 2)
    assert (back.stops_removed, back.stops_added) == (forth.stops_added, forth.stops_removed)
    assert stop_presence(old, new).filter("n_pending > 0 AND n_planning > 0").count() == 3


def test_stop_texts_repeat_and_are_sorted(spark):
    old = plan(spark, {}, stops=[])
    new = plan(spark, {}, stops=[(1, "I", 300, 200), (1, "I", 301, 200), (1, "O", 100, 301), (1, "I", 301, 200)])
    got = only(stop_changes(old, new))
    # An inbound and an outbound request at one point are two rows, equal requests are one.
    assert got.stops_added == "Third :: Three :: Three"
    assert (got.n_stops_added, got.stops_removed) == (3, "")


@pytest.mark.parametrize(
    "change, name, shown",
    [
        ({"name": "M"}, "route_name", ("N", "M")),
        ({"route_set_id": 21}, "route_set", ("SET 20", "SET 21")),
        ({"days": "MT"}, "days", ("MTWHF", "MT")),
        ({"origin_point_id": 300}, "anchor_location", ("Hundred", "Third")),
        ({"anchor_time_s": 25260}, "anchor_time", ("07:00:00", "07:01:00")),
        ({"vehicle_id": 11}, "vehicle", ("V10", "V11")),
        ({"desired_load": 11}, "desired_load", ("10", "11")),
        ({"actual_load": 16}, "actual_load", ("10", "16")),
        ({"route_distance": 600.5}, "route_distance", ("500", "600.5")),
        ({"route_time_s": 1981}, "route_time", ("1800", "1981")),
    ],
)
def test_each_attribute(spark, change, name, shown):
    got = only(tripchange_report(plan(spark, {}), plan(spark, change)))
    assert (got[f"{name}_removed"], got[f"{name}_added"]) == shown
    assert got.notes.endswith(f" {shown[0]} => {shown[1]}") and "\n" not in got.notes


def test_limits_are_strict_and_small_growth_has_no_note(spark):
    for change in ({"actual_load": 15}, {"route_distance": 600.0}, {"route_time_s": 1980}):
        old, new = plan(spark, {}), plan(spark, change)
        assert only(route_diff(old, new)).any_change
        assert tripchange_report(old, new).count() == 0
    tight = Thresholds(load=4, minutes=2, distance=99)
    assert tripchange_report(plan(spark, {}), plan(spark, {"actual_load": 15}), tight).count() == 1


def test_decreases_cancel_changes_unless_absolute(spark):
    old, new = plan(spark, {}), plan(spark, {"vehicle_id": 12, "actual_load": 2})
    assert not only(route_diff(old, new)).any_change
    fixed = only(tripchange_report(old, new, fixes=Fixes(any_change="abs")))
    assert fixed.notes == "Vehicle V10 => V12;\nYard EAST => WEST;\nActualLoad 10 => 2"


def test_earlier_anchor_time_is_not_shown(spark):
    old, new = plan(spark, {}), plan(spark, {"anchor_time_s": 25000, "vehicle_id": 11})
    got = only(route_diff(old, new))
    assert (got.anchor_time_diff, got.anchor_time_added, got.vehicle_added) == (-200, "", "V11")


def test_direction_and_anchor_slips_and_fixes(spark):
    old, new = plan(spark, {}), plan(spark, {"anchor_time_at_origin": "N"})
    plain = only(route_diff(old, new))
    assert (plain.direction_diff, plain.anchor_location_diff) == (0, None)
    fixed = only(route_diff(old, new, fixes=Fixes(anchor=True, direction=True)))
    assert (fixed.direction_removed, fixed.direction_added) == ("O", "I")
    assert (fixed.anchor_location_removed, fixed.anchor_location_added) == ("Hundred", "Two hundred")


def test_routes_of_one_plan_only(spark):
    second = {"record_id": 2, "visible_route_id": "2"}
    got = only(tripchange_report(plan(spark, {}), plan(spark, {}, second)))
    assert (got.visible_route_id, got.route_added, got.route_diff, got.vehicle_diff) == ("2", "2", 1, None)
    assert got.notes == "Route  => 2"
    gone = only(tripchange_report(plan(spark, {}, second), plan(spark, {})))
    assert gone.notes == "Route 2 => "


def test_old_rule(spark):
    def flagged(old: dict, new: dict) -> bool:
        found = old_change_rule(enrich_routes(plan(spark, old)), enrich_routes(plan(spark, new)))
        return found.count() == 1

    assert flagged({}, {"actual_load": 15}) and not flagged({}, {"actual_load": 14})
    assert flagged({}, {"route_time_s": 1980}) and not flagged({}, {"route_time_s": 1979})
    assert flagged({"actual_load": None}, {"actual_load": 5}) and not flagged({"actual_load": None}, {"actual_load": 4})
    assert not flagged({"route_time_s": None}, {}) and not flagged({}, {"route_time_s": None, "actual_load": None})
    assert flagged({}, {"vehicle_id": 11}) and not flagged({}, {"vehicle_id": 13})
    assert flagged({"record_id": 9}, {}) and flagged({"record_id": None}, {"record_id": None})


def test_old_rule_is_asked_by_record_id(spark):
    old = plan(spark, {"visible_route_id": "7"})
    new = plan(spark, {"visible_route_id": "7", "vehicle_id": 11})
    assert not only(route_diff(old, new)).in_old_rule
    assert only(route_diff(old, new, fixes=Fixes(old_rule_key="visible_route_id"))).in_old_rule


def test_notes_of_repeated_routes_are_shared_on_request(spark):
    old = plan(spark, {})
    new = plan(spark, {"vehicle_id": 11}, {"record_id": 2, "days": "MT"})
    shared = tripchange_report(old, new, repeated_routes=True).select("notes").distinct().collect()
    assert [r.notes for r in shared] == ["Days MTWHF => MT;\nVehicle V10 => V11"]
    own = tripchange_report(old, new).orderBy("notes").collect()
    assert [r.notes for r in own] == ["Days MTWHF => MT", "Vehicle V10 => V11"]


def test_row_notes_equal_grouped_notes(spark):
    old = plan(spark, {}, {"record_id": 2, "visible_route_id": "2"}, stops=[(1, "I", 300, 200)])
    new = plan(spark, {"vehicle_id": 12, "actual_load": 30}, stops=[(1, "I", 301, 200)])
    report = tripchange_report(old, new)
    grouped = change_notes(change_long(route_diff(old, new)))
    assert sorted(r.notes for r in report.collect()) == sorted(r.notes for r in grouped.collect())
    assert len(published_changes(report).columns) == 46
    assert sorted(report.columns) == sorted(tripchange_report(old, new, repeated_routes=True).columns)


def test_filters_on_the_report_stay_cheap_to_plan(spark):
    report = tripchange_report(plan(spark, {}), plan(spark, {"vehicle_id": 12}))
    assert report.filter((F.col("yard_diff") > 0) & (F.col("vehicle_added") != "")).count() == 1


def test_monitor_round_trip(spark):
    long = spark.createDataFrame(
        [(1, "P", "M", "Pickup", "R1", "B1"), (1, "P", "M", "Dropoff", None, "B2"), (2, "P", "F", "Pickup", "R2", None)],
        "record_id bigint, program_description string, day string, shift string, route string, bus string",
    )
    wide = monitor_wide(long)
    assert wide.count() == 2 and len(wide.columns) == 22
    again = monitor_long(wide)
    assert again.count() == 20
    assert again.filter("route IS NOT NULL OR bus IS NOT NULL").exceptAll(long.select(again.columns)).count() == 0


def test_missing_columns_are_named(spark):
    broken = dataclasses.replace(plan(spark, {}), routes=spark.range(1))
    with pytest.raises(ValueError, match="plan_route"):
        enrich_routes(broken)


def test_parts_of_a_comparison_are_staged_one_by_one(spark, tmp_path):
    """The same rows as in one plan, null and repeated keys included."""
    old = plan(
        spark, {}, {"record_id": 2, "visible_route_id": "2", "vehicle_id": None}, {"record_id": 3, "visible_route_id": None},
        {"record_id": None, "visible_route_id": "4"}, {"record_id": 2, "visible_route_id": "2", "actual_load": 40},
        stops=[(1, "I", 300, 1), (1, "O", 1, 301), (2, "X", 300, 200), (None, "I", None, 1)],
    )
    new = plan(
        spark, {"name": "M"}, {"record_id": 2, "visible_route_id": "2", "vehicle_id": 11}, {"record_id": 5, "visible_route_id": None},
        stops=[(1, "I", 301, 1), (2, "X", 300, 200), (2, "O", None, 302)],
    )
    fixes = Fixes(anchor=True, direction=True, any_change="abs")
    parts = route_diff(old, new, fixes=fixes, staging=str(tmp_path))
    assert sorted(map(str, parts.collect())) == sorted(map(str, route_diff(old, new, fixes=fixes).collect()))
    # What is joined (ids, stop changes and the routes of either side), and before that of either side what serves
    # requests and the stops.
    assert parts._jdf.queryExecution().analyzed().toString().count("parquet") == 4
    assert len(list(tmp_path.iterdir())) == 8


def shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.getName() for f in blocks.localDirs() for f in f.listFiles() for f in f.listFiles() or [] if f.getName().endswith(".data")}


def test_staging_removes_its_shuffle_files(spark, tmp_path):
    rows = spark.range(20_000)
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    before = shuffle_files(spark)
    kept = stage(rows.repartition(4, "id"), str(tmp_path))
    for _ in range(100):  # they are removed in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert kept.count() == 20_000
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    spark.conf.unset(SHUFFLE_CLEANUP)
