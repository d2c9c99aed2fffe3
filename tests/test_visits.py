"""Visit matching against brute force over all pairs, with many visits and trips under one key."""

import datetime as dt
import random
from collections import Counter, defaultdict

from kerbside.functions.rules import Cutoffs
from kerbside.operators.visits import closest_visits, match_visits, nearest_visits, service_windows, visits_in_windows
from kerbside.plans.on_time import on_time_candidates, one_per_route

DAY = dt.date(2024, 3, 1)
MIDNIGHT = dt.datetime(2024, 3, 1)
TRIPS = (
    "rp_vehicle string, anchor_abbrev string, rp_route string, expected_time timestamp_ntz, effective_date date, "
    "direction string, actual_time timestamp_ntz, delay_time int, overnight_garage string, route_set_name string, "
    "route_name string, actual_load int, days string"
)
VISITS = (
    "rp_vehicle string, anchor_abbrev string, zone string, effective_date date, direction string, "
    "gps_time timestamp_ntz, gps_category string, gps_duration double"
)


def moment(rng, step=1):
    return MIDNIGHT + dt.timedelta(hours=7, microseconds=rng.randrange(0, 3_600_000_000, step))


def cut(delta: dt.timedelta) -> int:
    micros = delta // dt.timedelta(microseconds=1)
    return micros // 60_000_000 if micros >= 0 else -(-micros // 60_000_000)


def make(seed: int, n_trips: int, n_visits: int):
    """A third of all rows share one vehicle and anchor; some keys, times and durations are missing; some rows repeat."""
    rng = random.Random(seed)

    def key():
        hot = rng.random() < 0.34
        return ("B1", "A1") if hot else (rng.choice(["B1", "B2", None]), rng.choice(["A1", "A2", None]))

    trips = []
    for _ in range(n_trips):
        expected = None if rng.random() < 0.1 else moment(rng, rng.choice([1, 60_000_000]))
        actual = None if expected is None or rng.random() < 0.3 else expected + dt.timedelta(seconds=rng.randrange(-4000, 5000))
        delay = None if actual is None else cut(actual - expected)
        route = rng.choice(["R1", "R2", "R3", None])
        trips.append((*key(), route, expected, DAY, "I", actual, delay, "G", "S", "N", 3, "M"))
    visits = []
    for _ in range(n_visits):
        zone = rng.choice(["Z1", "Z2", None])
        duration = rng.choice([None, 1.0, 2.0])
        visits.append((*key(), zone, DAY, "I", moment(rng, rng.choice([1, 10_000_000])), rng.choice(["c1", "c2"]), duration))
    visits += visits[: n_visits // 3]
    return trips, visits


def brute_closest(trips, visits) -> Counter:
    groups = defaultdict(list)
    for v, a, r, e, d, k in {t[:6] for t in trips}:
        for vv, va, z, vd, vk, t, c, s in visits:
            if (v, a, d, k) == (vv, va, vd, vk):
                delay = None if e is None else cut(t - e)
                groups[(z, v, r, d, k)].append((v, a, r, e, d, k, z, t, delay, c, s))
    kept = Counter()
    for rows in groups.values():
        known = [abs(r[8]) for r in rows if r[8] is not None]
        best = min(known) if known else None
        kept.update(r for r in rows if (r[8] is None) == (best is None) and (best is None or abs(r[8]) == best))
    return kept


def test_closest_visits_equal_brute_force(spark):
    for seed, n_trips, n_visits in ((1, 60, 300), (2, 30, 900), (3, 200, 50)):
        trips, visits = make(seed, n_trips, n_visits)
        got = closest_visits(spark.createDataFrame(trips, TRIPS), spark.createDataFrame(visits, VISITS))
        assert Counter(tuple(r) for r in got.collect()) == brute_closest(trips, visits)


def test_report_visits_lead_to_the_same_pick_as_all_ties(spark):
    for seed in range(4, 8):
        trips, visits = make(seed, 80, 500)
        t, v = spark.createDataFrame(trips, TRIPS), spark.createDataFrame(visits, VISITS)
        for prefer in (False, True):
            picks = [
                one_per_route(on_time_candidates(t, found, Cutoffs(), "GPS", "Schedule"), prefer).orderBy("rp_route").collect()
                for found in (closest_visits(t, v), nearest_visits(t, v))
            ]
            assert picks[0] == picks[1]
            assert len(picks[0]) == len({x[2] for x in trips})


def test_match_row_numbers_do_not_depend_on_pairs(spark):
    trips, visits = make(9, 100, 600)
    matches = match_visits(spark.createDataFrame(trips, TRIPS), spark.createDataFrame(visits, VISITS)).collect()
    keys = {(m.rp_vehicle, m.anchor_abbrev, m.rp_route, m.expected_time, m.zone, m.gps_category) for m in matches}
    assert len(keys) == len(matches)


def test_full_and_left_join_of_matches_agree(spark):
    trips, visits = make(10, 60, 200)
    t = spark.createDataFrame(trips, TRIPS)
    found = closest_visits(t, spark.createDataFrame(visits, VISITS))
    keys = ["rp_vehicle", "anchor_abbrev", "rp_route", "expected_time", "effective_date", "direction"]
    right = found.withColumnsRenamed({k: f"r_{k}" for k in keys})
    same = [t[k].eqNullSafe(right[f"r_{k}"]) for k in keys]
    assert t.join(right, same, "full").count() == t.join(right, same, "left").count()


def test_windows_hold_both_ends_and_cross_midnight(spark):
    day, next_day = dt.date(2024, 3, 1), dt.date(2024, 3, 2)
    trips = spark.createDataFrame(
        [
            (day, "O", dt.datetime(2024, 3, 1, 23, 45), False), (day, "O", dt.datetime(2024, 3, 1, 13, 0), False),
            (day, "O", dt.datetime(2024, 3, 1, 6, 0), True), (day, "O", None, False), (next_day, "I", None, False),
        ],
        "effective_date date, direction string, expected_time timestamp_ntz, excluded boolean",
    )
    windows = service_windows(trips)
    bounds = windows.filter("direction = 'O'").first()
    assert (bounds.start_time, bounds.end_time) == (dt.datetime(2024, 3, 1, 12, 30), dt.datetime(2024, 3, 2, 0, 15))
    times = [
        (1, dt.datetime(2024, 3, 1, 12, 30)), (2, dt.datetime(2024, 3, 1, 12, 29, 59)),
        (3, dt.datetime(2024, 3, 2, 0, 15)), (4, dt.datetime(2024, 3, 2, 0, 15, 1)), (5, dt.datetime(2024, 3, 1, 20, 0)),
    ]
    visits = spark.createDataFrame(times, "i int, time_in timestamp_ntz")
    for days in (2, None, 10**9):
        kept = visits_in_windows(visits, windows, days)
        assert sorted(r.i for r in kept.collect()) == [1, 3, 5]
    capped = service_windows(trips, as_of=dt.datetime(2024, 3, 1, 15, 0))
    assert sorted(r.i for r in visits_in_windows(visits, capped, 2).collect()) == [1]
