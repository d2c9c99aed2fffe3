"""Column rules at their bounds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbside.functions import rules, text, times
from kerbside.functions.rules import Cutoffs

T0 = dt.datetime(2024, 3, 1, 7, 30)
GPS, SYSTEM = dt.datetime(2024, 3, 1, 7, 0), dt.datetime(2024, 3, 1, 8, 0)

# gps delay, system delay, chosen source. Cutoffs are -25 and 60; every bound is strict.
ARRIVALS = [
    (5, 61, "G"), (5, -11, "G"), (5, 60, "G"), (59, 61, "G"), (-9, -20, "G"),
    (61, 5, "S"), (-11, 5, "S"), (-20, -9, "S"),
    (-20, -26, "G"), (-24, 61, "G"), (-10, 61, "G"),
    (-26, -20, "S"), (61, -24, "S"), (61, -10, "S"),
    (20, 5, "S"), (5, 20, "G"), (5, 5, "G"), (-5, 5, "G"), (60, 5, "S"), (-10, 5, "S"), (-10, -11, "G"),
    (-25, 10, "S"), (10, -25, "G"), (70, 65, "S"), (65, 70, "G"), (-30, -40, "G"),
    (None, 5, "G"), (5, None, "G"), (None, None, "G"),
]


def test_arrival_choice(spark):
    rows = [(i, g, s, GPS, SYSTEM) for i, (g, s, _) in enumerate(ARRIVALS)]
    df = spark.createDataFrame(rows, "i int, g int, s int, gps timestamp_ntz, system timestamp_ntz")
    chosen = rules.choose_arrival(F.col("g"), F.col("s"), F.col("gps"), F.col("system"), Cutoffs())
    got = {r.i: r.a for r in df.select("i", chosen.alias("a")).collect()}
    wanted = {i: GPS if source == "G" else SYSTEM for i, (_, _, source) in enumerate(ARRIVALS)}
    assert got == wanted


def test_arrival_falls_back_to_the_source_that_is_there(spark):
    df = spark.createDataFrame(
        [(1, None, SYSTEM), (2, GPS, None), (3, None, None)], "i int, gps timestamp_ntz, system timestamp_ntz"
    )
    none = F.lit(None).cast("int")
    chosen = rules.choose_arrival(none, F.lit(3), F.col("gps"), F.col("system"), Cutoffs())
    source = rules.arrival_source(F.col("a"), F.col("gps"), F.col("system"))
    got = df.withColumn("a", chosen).select("i", "a", source.alias("source")).orderBy("i").collect()
    assert [tuple(r) for r in got] == [(1, SYSTEM, "Schedule"), (2, GPS, "GPS"), (3, None, None)]


def test_equal_times_count_as_gps(spark):
    df = spark.createDataFrame([(GPS, GPS)], "gps timestamp_ntz, system timestamp_ntz")
    source = rules.arrival_source(F.col("gps"), F.col("gps"), F.col("system"))
    assert df.select(source).first()[0] == "GPS"


def test_window_is_open_and_null_without_delay(spark):
    df = spark.createDataFrame([(-25,), (-24,), (59,), (60,), (None,)], "d int")
    got = [r[0] for r in df.select(rules.in_window(F.col("d"), Cutoffs())).collect()]
    assert got == [False, True, True, False, None]


def test_categories(spark):
    cases = [
        (True, True, True, 1, "Excluded"),
        (False, True, None, None, "Uncovered"),
        (False, False, False, 99, "Arrived outside window"),
        (False, False, True, 3, "Reported"),
        (False, False, None, None, "Unreported"),
    ]
    df = spark.createDataFrame(cases, "e boolean, u boolean, w boolean, d int, wanted string")
    category = rules.trip_category(F.col("e"), F.col("u"), F.col("w"), F.col("d"))
    assert df.filter(~category.eqNullSafe(F.col("wanted"))).count() == 0


@pytest.mark.parametrize("name, limit", rules.LATENESS_LIMITS.items())
def test_lateness_flag(spark, name, limit):
    df = spark.createDataFrame(
        [(False, limit - 1), (False, limit), (False, limit + 1), (True, 0), (True, None), (False, None)],
        "u boolean, d int",
    )
    got = [r[0] for r in df.select(rules.on_time_flag(F.col("u"), F.col("d"), limit)).collect()]
    assert got == [1.0, 1.0, 0.0, 0.0, 0.0, None]


def test_time_tiers(spark):
    df = spark.createDataFrame([(450,), (451,), (510,), (511,), (650,), (651,), (None,)], "m int")
    got = [r[0] for r in df.select(rules.time_tier(F.col("m"))).collect()]
    assert got == ["7:30", "8:30", "8:30", "9:30", "9:30", "", ""]


def test_yards_and_directions(spark):
    df = spark.createDataFrame([("FREEPORT", "N"), ("READVILLE", "Y"), ("WASHINGTON", "x"), ("OTHER", None)], "g string, d string")
    got = df.select(rules.yard_code(F.col("g")), rules.direction_code(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [("Frpt", "I"), ("Read", "O"), ("Wash", None), (None, None)]
    assert rules.directions_for(("AM", "PM")) == ["I", "O"]
    with pytest.raises(ValueError):
        rules.directions_for(("NOON",))


def test_exclusion(spark):
    cases = [
        (0, "SET 1 AM", True), (1, "SET 1 AM", False), (0, "CHARLESTOWN HS Combo AM", False), (0, None, False),
        (5, None, False), (None, "SET 1 AM", False), (5, "BOSTON BALLET pm", True), (5, "Strive East Shuttle AM", True),
        (5, "Horace Mann Afterschool PM", True), (5, "FSB BOS COLLAB ALL DAY 2", True), (5, "Shuttle Strive", False),
    ]
    df = spark.createDataFrame(cases, "load int, name string, wanted boolean")
    assert df.filter(rules.is_excluded(F.col("load"), F.col("name")) != F.col("wanted")).count() == 0


def test_half_day_of_set_name(spark):
    cases = [("East pm Combo", "PM"), ("am pm", "AM"), ("SHAM PMX", None), ("X-AM", "AM"), ("", None), (None, None)]
    df = spark.createDataFrame(cases, "name string, wanted string")
    assert df.filter(~text.ampm_of(F.col("name")).eqNullSafe(F.col("wanted"))).count() == 0


def test_texts(spark):
    df = spark.createDataFrame([("  a \t b\n", "GARAGE ST 1", "", "plain"), (None, None, None, None)], "s string, g string, c string, d string")
    got = df.select(
        text.squish(F.col("s")), text.garage_short(F.col("g")), text.stop_text(F.col("c"), F.col("d")), text.text_or_na(F.col("s"))
    ).collect()
    assert tuple(got[0]) == ("a b", "GARAGE", "plain", "  a \t b\n")
    assert tuple(got[1]) == (None, None, None, "NA")
    numbers = spark.createDataFrame([("0420",), ("12.7",), ("x",), ("99999999999",), (None,), ("101D",), ("12f",)], "r string")
    assert [r[0] for r in numbers.select(text.route_number(F.col("r"))).collect()] == [420, 12, None, None, None, None, None]
    seconds = spark.createDataFrame([(25200,), (86399,), (None,)], "s int")
    assert [r[0] for r in seconds.select(F.when(F.col("s").isNotNull(), text.clock_text(F.col("s")))).collect()] == ["07:00:00", "23:59:59", None]
    spaces = spark.createDataFrame([("\u00a0a\u2003\u00a0b ",)], "s string")
    assert spaces.select(text.squish(F.col("s"))).first()[0] == "a b"
    lengths = spark.createDataFrame([(120.0,), (120.5,), (12345678.0,), (0.0005,), (0.0,), (None,)], "d double")
    assert [r[0] for r in lengths.select(text.number_text(lengths, "d")).collect()] == ["120", "120.5", "12345678", "0.0005", "0", None]


def test_times(spark):
    day = dt.date(2024, 3, 1)
    cases = [
        (T0 + dt.timedelta(seconds=119), 1), (T0 - dt.timedelta(seconds=119), -1), (T0 + dt.timedelta(seconds=59), 0),
        (T0 - dt.timedelta(seconds=60), -1), (None, None),
    ]
    df = spark.createDataFrame([(T0, a, w) for a, w in cases], "e timestamp_ntz, a timestamp_ntz, wanted int")
    assert df.filter(~times.delay_minutes(F.col("e"), F.col("a")).eqNullSafe(F.col("wanted"))).count() == 0
    other = dt.datetime(2023, 12, 31, 23, 59, 59, 123456)
    halves = [dt.datetime(2024, 3, 1, 0, 2, 30), dt.datetime(2024, 3, 1, 0, 3, 30)]
    df = spark.createDataFrame([(day, other, *halves)], "day date, t timestamp_ntz, a timestamp_ntz, b timestamp_ntz")
    got = df.select(
        times.rebase_date(F.col("t"), F.col("day")), times.minutes_of_day(F.col("a"), F.col("day")),
        times.minutes_of_day(F.col("b"), F.col("day")), times.us_date(F.col("day")), times.clock(F.col("t")),
    ).first()
    assert tuple(got) == (dt.datetime(2024, 3, 1, 23, 59, 59, 123456), 2.0, 4.0, "03/01/2024", "23:59")


def test_times_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    day = dt.date(2024, 3, 10)
    skipped, later = dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 3, 10)
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(day, skipped, later)], "day date, a timestamp_ntz, b timestamp_ntz")
        got = df.select(
            times.delay_minutes(F.col("a"), F.col("b")), times.delay_minutes(F.col("b"), F.col("a")),
            times.minutes_of_day(F.col("a"), F.col("day")), times.clock(F.col("a")), times.us_date(F.col("day")),
            times.rebase_date(F.col("b"), F.col("day")),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(got) == (40, -40, 150.0, "02:30", "03/10/2024", later)
