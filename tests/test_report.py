"""Properties of the on-time report and of what is made of it."""

import datetime as dt
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from kerbside.catalog.queries import Inputs
from kerbside.functions.rules import Cutoffs
from kerbside.operators.uncovered import reconcile_uncovered
from kerbside.plans import daily_rates, on_time
from kerbside.plans.on_time import REPORT_COLUMNS, covered_trips, otp_report, unreported_trips, vendor_names

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Inputs(spark, SF_DIR).on_time()


@pytest.fixture(scope="module")
def report(tables):
    return otp_report(tables, keep_listed=True).cache()


def rows(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def test_one_row_per_route_day_and_direction(tables, report):
    keys = ["rp_route", "date", "direction"]
    once = otp_report(tables, include_visits=True).select(keys).distinct().count()
    trips = tables.trips.select("rp_route", "effective_date", "direction").distinct().count()
    assert once == trips
    # Only rows that the uncovered list names more than once may repeat.
    repeated = report.groupBy(*keys).agg(F.count("*").alias("n"), F.max("listed_uncovered").alias("listed"))
    assert repeated.filter("n > 1 AND NOT listed").count() == 0


def test_every_row_has_a_category_and_all_columns(report):
    assert report.drop("listed_uncovered").columns == REPORT_COLUMNS
    assert len(REPORT_COLUMNS) == 34
    assert report.filter("trip_category IS NULL OR trip_category = 'Unknown'").count() == 0
    assert report.filter("uncovered AND (in_gps OR in_system)").count() == 0


def test_many_days_equal_single_runs(tables, report):
    days = [r[0] for r in tables.trips.select("effective_date").distinct().orderBy("effective_date").limit(2).collect()]
    together = otp_report(tables, days[0], days[1])
    single = [
        otp_report(tables, day, day, half_days=(half,)) for day in days for half in ("AM", "PM")
    ]
    stacked = single[0].unionByName(single[1]).unionByName(single[2]).unionByName(single[3])
    assert rows(together) == rows(stacked)
    assert rows(together) == rows(report.drop("listed_uncovered").filter(F.col("date").isin(days)))


def test_result_does_not_depend_on_partitions(spark, tables, report):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert rows(otp_report(tables, keep_listed=True)) == rows(report)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_staged_run_is_the_same(tables, report, tmp_path):
    assert rows(otp_report(tables, keep_listed=True, staging=tmp_path.as_uri())) == rows(report)
    assert list(tmp_path.glob("stage-*/*.parquet"))


def test_without_visits(tables):
    alone = otp_report(tables, include_visits=False)
    assert alone.filter("in_gps OR gps_time IS NOT NULL OR zone IS NOT NULL").count() == 0
    assert alone.filter("arrival_source = 'Schedule'").count() > 0


def test_as_of_drops_later_visits(tables, report):
    first = report.agg(F.min("date")).first()[0]
    noon = dt.datetime.combine(first, dt.time(6, 0))
    early = otp_report(tables, first, first, as_of=noon)
    assert early.filter(F.col("gps_time") > F.lit(noon)).count() == 0


def test_half_day_is_checked(tables):
    with pytest.raises(ValueError):
        otp_report(tables, half_days=("NOON",))


def test_wider_cutoffs_move_trips_into_the_window(tables, report):
    wide = otp_report(tables, cutoffs=Cutoffs(-10_000, 10_000))
    assert wide.filter("trip_category = 'Arrived outside window'").count() == 0
    assert report.filter("trip_category = 'Arrived outside window'").count() > 0
    assert wide.select("cutoff_min", "cutoff_max").distinct().collect() == [(-10_000.0, 10_000.0)]


def test_unreported(report):
    left_out = unreported_trips(report)
    assert left_out.filter("NOT excluded AND (delay_combined IS NOT NULL OR uncovered)").count() == 0
    assert left_out.filter("excluded").count() == report.filter("excluded").count()


def test_early_candidates_come_first_unless_told_otherwise(spark):
    day = dt.date(2024, 3, 1)
    planned = dt.datetime(2024, 3, 1, 8, 0)
    base = {
        "rp_route": "R", "effective_date": day, "direction": "I", "expected_time": planned, "rp_vehicle": "B",
        "anchor_abbrev": "A", "zone": None, "gps_time": None, "delay_time": None, "overnight_garage": None,
        "gps_category": None, "gps_duration": None, "route_set_name": None, "route_name": None, "actual_load": 1,
        "days": None,
    }
    schema = (
        "rp_route string, effective_date date, direction string, expected_time timestamp_ntz, rp_vehicle string, "
        "anchor_abbrev string, zone string, gps_time timestamp_ntz, delay_time int, overnight_garage string, "
        "gps_category string, gps_duration double, route_set_name string, route_name string, actual_load int, "
        "days string, arrival timestamp_ntz, actual_time timestamp_ntz, delay_combined int, arrival_in_window boolean"
    )
    def row(delay):
        arrival = None if delay is None else planned + dt.timedelta(minutes=delay)
        inside = None if delay is None else -25 < delay < 60
        return {**base, "arrival": arrival, "actual_time": arrival, "delay_combined": delay, "arrival_in_window": inside}

    df = spark.createDataFrame([row(d) for d in (3, -20, -40, None, 90)], schema)
    assert on_time.one_per_route(df).first().delay_combined == -20
    assert on_time.one_per_route(df, prefer_not_early=True).first().delay_combined == 3
    ties = spark.createDataFrame([row(5), row(-5)], schema)
    assert on_time.one_per_route(ties).first().delay_combined == -5
    assert on_time.one_per_route(spark.createDataFrame([row(None), row(99)], schema)).first().delay_combined == 99


def test_reconcile_splits_the_list(tables, report):
    covered = covered_trips(report)
    for match in ("all", "any"):
        kept, removed = reconcile_uncovered(tables.uncovered, covered, match)
        assert rows(kept) + rows(removed) == rows(tables.uncovered)
    with pytest.raises(ValueError):
        reconcile_uncovered(tables.uncovered, covered, "some")


def test_reconcile_matches_the_four_keys_together(spark):
    day, other = dt.date(2024, 3, 1), dt.date(2024, 3, 2)
    listed = spark.createDataFrame(
        [(day, "am", " East  AM", "B1"), (day, "AM", "East AM", "B2"), (other, "AM", "West AM", "B1")],
        "date date, ampm string, route_set string, bus string",
    )
    covered = spark.createDataFrame(
        [(day, "AM", "East AM", "B1", "B9"), (other, "AM", "West AM", "B7", "B2")],
        "date date, ampm string, route_set_name string, original_rp_vehicle string, rp_vehicle string",
    )
    removed = reconcile_uncovered(listed, covered)[1]
    assert [r.bus for r in removed.collect()] == ["B1"]
    # Membership of each key alone, raw text and the vehicle that drove.
    anyhow = reconcile_uncovered(listed, covered, "any")[1]
    assert [r.bus for r in anyhow.collect()] == ["B2"]


def test_flat_layout(report):
    raw = daily_rates.prepare_raw(report)
    assert raw.columns == list(daily_rates.FLAT_HEADINGS)
    assert daily_rates.prepare_raw(raw) is raw
    old = daily_rates.prepare_raw(report, oldstyle=True)
    assert len(old.columns) == 26 and raw.columns[:26] == old.columns
    assert daily_rates.prepare_raw(old) is old
    with pytest.raises(ValueError, match="excluded"):
        daily_rates.otp_summary(old)
    assert daily_rates.own_names(daily_rates.published_names(raw)).columns == raw.columns
    assert "Planned.Anchor.Time" in daily_rates.published_names(raw).columns
    with pytest.raises(ValueError):
        daily_rates.prepare_raw(report.select("rp_route"))


def test_summary_from_report_and_from_flat_rows(report):
    summary = daily_rates.otp_summary(report)
    assert len(summary.columns) == 18
    assert rows(summary) == rows(daily_rates.otp_summary(daily_rates.prepare_raw(report)))
    assert summary.count() == report.select("date").distinct().count()
    assert daily_rates.published_names(summary).columns[0] == "OTP_Date"


def test_published_names_carry_the_systems(report):
    names = vendor_names(report, gps="Gps", system="Sys").columns
    assert len(names) == 34
    assert {"GpsActualTime", "GpsDelayTime", "InGps", "InSys", "ZoneInGps", "excludedShuttlesEtc"} <= set(names)


def test_scans_are_bounded_by_the_asked_days(spark, tables, tmp_path):
    day = dt.date.fromisoformat(str(tables.trips.agg(F.min("effective_date")).first()[0]))
    tables.visits.write.parquet(f"{tmp_path}/visits")
    schedule = tables.location_schedule
    schedule.write.parquet(f"{tmp_path}/schedule")
    trips = tables.trips.withColumn("effective_date", F.col("effective_date").cast("timestamp_ntz"))
    stored = replace(
        tables,
        trips=trips,
        visits=spark.read.parquet(f"{tmp_path}/visits"),
        location_schedule=spark.read.parquet(f"{tmp_path}/schedule"),
    )
    one_day = otp_report(stored, day, day)
    plan = one_day._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    seen = [line for line in pushed if "time_in" in line]
    assert seen and all("GreaterThanOrEqual(time_in" in x and "LessThanOrEqual(time_in" in x for x in seen)
    assert any("LessThanOrEqual(effective_date" in x and "GreaterThanOrEqual(effective_date" in x for x in pushed)
    assert rows(one_day) == rows(otp_report(tables, day, day))
