"""GPS zone visits and their match with planned trips.

A vehicle can be in a zone many times and serve many trips there, so the plain join of trips and visits would emit every
pair. Only the closest visits count, and one pass over the visits finds them without the pairs:

1. visits are reduced to one row per vehicle, anchor, zone, half-day and minute (a combining aggregate); a half-day has a
   bounded number of minutes, whatever the number of visits;
2. the minutes of a zone are swept in order, once for every hour with a planned time: its own minutes with the two before
   and the two after it, so that no row holds more than 64 and a busy vehicle and anchor are spread over the hours;
3. every distinct trip meets the row of its hour and takes the smallest gap; only the best trips of a group go on;
4. the visits at that gap come from the row itself, all of them or one per minute, never from the visits again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions.text import squish_strings
from kerbside.functions.times import MICROS_PER_MINUTE, delay_minutes, micros_between, micros_of_day
from kerbside.operators.joins import join_on
from kerbside.schemas import ZONE, ZONE_VISIT, TableSpec

HALF_DAY = ["effective_date", "direction"]
TRIP_KEY = ["rp_vehicle", "anchor_abbrev", "rp_route", "expected_time"]
WINDOW_MARGIN = "INTERVAL '30' MINUTE"

# Stands for the hour of a missing planned time.
NO_HOUR = -1_000_000

# Copies of a visit that are given back at once.
COPIES = 4096

# A service date has two windows that touch at most three calendar dates each; a row takes about 40 bytes.
WINDOW_ROWS_PER_DAY = 6
MAX_BROADCAST_ROWS = 500_000


def zone_categories(zones: DataFrame) -> DataFrame:
    return squish_strings(ZONE.select_from(zones).select("category", "type")).distinct()


def drop_other_categories(visits: DataFrame, zones: DataFrame) -> DataFrame:
    """Cleaned visits without those of a category whose type is ``other``."""
    other = zone_categories(zones).filter(F.col("type") == "other").select("category")
    return join_on(squish_strings(visits), other, plain=["category"], how="left_anti")


def service_windows(trips: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Per date and direction: from 30 minutes before the first to 30 after the last planned time that counts.

    ``as_of`` caps the end, so that a report of a running day asks for no later visits.
    """
    # Aggregated under a condition instead of filtered, so that the trips' plan stays that of other branches.
    time = F.when(~F.col("excluded"), F.col("expected_time"))
    bounds = trips.groupBy(*HALF_DAY).agg(
        F.min(time).alias("first_time"), F.max(time).alias("last_time"), F.count_if(~F.col("excluded")).alias("n")
    )
    bounds = bounds.filter(F.col("n") > 0)
    start = F.expr(f"first_time - {WINDOW_MARGIN}")
    end = F.expr(f"last_time + {WINDOW_MARGIN}")
    if as_of is not None:
        end = F.least(end, F.lit(as_of.isoformat()).cast("timestamp_ntz"))
    return bounds.select(*HALF_DAY, start.alias("start_time"), end.alias("end_time"))


def visits_near_days(
    visits: DataFrame,
    span: tuple[dt.date, dt.date],
    as_of: dt.datetime | None = None,
    dated_by: str | None = None,
) -> DataFrame:
    """Visits that a window of these service dates can hold. A range of literals, so that it reaches the scan.

    Planned times lie on their service date, and windows reach 30 minutes beyond them. ``dated_by`` names a column with
    the date of ``time_in`` by which the visits are stored; folders of other dates are then not listed.
    """
    margin = dt.timedelta(minutes=30)
    start = dt.datetime.combine(span[0], dt.time()) - margin
    end = dt.datetime.combine(span[1], dt.time()) + dt.timedelta(days=1) + margin
    if as_of is not None:
        end = min(end, as_of.replace(tzinfo=None))
    if dated_by is not None:
        dates = [F.lit(str(t.date())).cast("date") for t in (start, end)]
        visits = visits.filter(F.col(dated_by).between(*dates))
    time_in = F.col("time_in")
    return visits.filter((time_in >= _moment(start)) & (time_in <= _moment(end)))


def _moment(at: dt.datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def visits_in_windows(
    visits: DataFrame, windows: DataFrame, service_days: int | None = None, dated_by: str | None = None
) -> DataFrame:
    """Visits with the date and direction of every service window they start in, both ends included.

    The windows are spread over the one to three calendar dates they touch and joined on that date. ``service_days``, an
    upper bound on their number of dates, bounds their rows; they are broadcast if that is small enough. Otherwise
    Spark chooses the join by size, and AQE splits dates with very many visits. ``dated_by`` names a column with the date
    of ``time_in``; if the visits are stored by it, only the dates of the broadcast windows are read.
    """
    dates = F.sequence(F.to_date("start_time"), F.to_date("end_time"))
    usable = windows.filter(F.col("start_time") <= F.col("end_time"))
    dated = usable.withColumn("visit_date", F.explode(dates))
    if service_days is not None and service_days * WINDOW_ROWS_PER_DAY <= MAX_BROADCAST_ROWS:
        dated = F.broadcast(dated)
    if dated_by is None:
        visits, dated_by = visits.withColumn("visit_date", F.to_date("time_in")), "visit_date"
    found = join_on(visits, dated, plain=[(dated_by, "visit_date")], how="inner")
    inside = F.col("time_in").between(F.col("start_time"), F.col("end_time"))
    return found.filter(inside).drop(dated_by, "start_time", "end_time")


def typed_visits(visits: DataFrame, dated_by: str | None = None) -> DataFrame:
    """The needed columns of the visits, with the column that dates them, if any, at the end."""
    typed = ZONE_VISIT.select_from(visits)
    if dated_by is None:
        return typed
    spec = TableSpec(ZONE_VISIT.name, (*ZONE_VISIT.columns, (dated_by, dated_by, "date")))
    return spec.select_from(visits)


def visit_anchors(visits: DataFrame, anchored: DataFrame) -> DataFrame:
    """Visits with the anchor of the building that their zone is named after, if any."""
    return join_on(visits, anchored, null_safe=[("zone", "name")])


def prepare_visits(
    visits: DataFrame,
    zones: DataFrame,
    anchored: DataFrame,
    windows: DataFrame,
    span: tuple[dt.date, dt.date] | None = None,
    as_of: dt.datetime | None = None,
    dated_by: str | None = None,
) -> DataFrame:
    """Visits that can be matched: category, window and anchor applied.

    ``span``, the first and the last service date, bounds the scan of the visits and the number of windows. ``dated_by``
    names a column with the date of ``time_in`` by which the visits are stored.
    """
    typed, service_days = typed_visits(visits, dated_by), None
    if span is not None:
        typed, service_days = visits_near_days(typed, span, as_of, dated_by), (span[1] - span[0]).days + 1
    kept = drop_other_categories(typed, zones)
    placed = visit_anchors(visits_in_windows(kept, windows, service_days, dated_by), anchored)
    return placed.select(
        F.col("asset").alias("rp_vehicle"),
        "anchor_abbrev",
        "zone",
        *HALF_DAY,
        F.col("time_in").alias("gps_time"),
        F.col("category").alias("gps_category"),
        F.col("duration_s").alias("gps_duration"),
    )


PLACE = ["zone", "gps_category"]
MATCH_KEY = ["rp_vehicle_key", "anchor_abbrev_key", *HALF_DAY]


def _minute(ts: str) -> Column:
    return F.floor(micros_of_day(F.col(ts), F.col("effective_date")) / MICROS_PER_MINUTE)


def _with_keys(df: DataFrame) -> DataFrame:
    """Vehicle and anchor as never-null texts, equal for equal values and for missing ones."""
    names = ["rp_vehicle", "anchor_abbrev"]
    return df.withColumns({f"{n}_key": F.coalesce(F.concat(F.lit("="), F.col(n)), F.lit("")) for n in names})


def _spot(**more: Column) -> Column:
    """A minute with visits: its number, the moments of its first and last visit, and ``more``."""
    micros = [micros_of_day(F.col(c), F.col("effective_date")).alias(f"{c}_micros") for c in ("first", "last")]
    return F.struct("minute", *micros, *[c.alias(n) for n, c in more.items()])


def minutes_with_visits(visits: DataFrame) -> DataFrame:
    """Per vehicle, anchor, half-day, zone and category one row for each minute with visits: minute, spot and n.

    The spot has the first and the last visit. Of visits at the same moment the one with the smallest duration counts,
    a missing one last.
    """
    duration = F.col("gps_duration")
    first = F.min(F.struct("gps_time", duration.isNull().alias("unknown"), duration.alias("duration")))
    last = F.max(F.struct("gps_time", duration.isNotNull().alias("known"), (-duration).alias("minus_duration")))
    minutes = _with_keys(visits).withColumn("minute", _minute("gps_time")).groupBy(*MATCH_KEY, *PLACE, "minute")
    ends = minutes.agg(first.alias("f"), last.alias("l"), F.count(F.lit(1)).alias("n"))
    ends = ends.withColumns({"first": F.col("f.gps_time"), "last": F.col("l.gps_time")})
    own = {"first": F.col("first"), "first_duration": F.col("f.duration"), "last": F.col("last"),
           "last_duration": -F.col("l.minus_duration")}
    return ends.select(*MATCH_KEY, *PLACE, "minute", _spot(**own).alias("spot"), "n")


def minutes_with_every_visit(visits: DataFrame) -> DataFrame:
    """``minutes_with_visits`` with a spot that lists all visits of its minute, equal ones once with their number.

    Copies are counted before the shuffle; a list is as long as its minute has different moments and durations.
    """
    copies = _with_keys(visits).withColumn("minute", _minute("gps_time"))
    copies = copies.groupBy(*MATCH_KEY, *PLACE, "minute", "gps_time", "gps_duration").agg(F.count(F.lit(1)).alias("n"))
    # Dealt by the key that the match needs, so that minutes, lists and match share this shuffle.
    minutes = copies.repartition(*MATCH_KEY).groupBy(*MATCH_KEY, *PLACE, "minute")
    listed = minutes.agg(
        F.min("gps_time").alias("first"), F.max("gps_time").alias("last"),
        F.collect_list(F.struct("gps_time", "gps_duration", "n")).alias("visits"), F.sum("n").alias("n"),
    )
    return listed.select(*MATCH_KEY, *PLACE, "minute", _spot(visits=F.col("visits")).alias("spot"), "n")


def _hour(minute: Column) -> Column:
    return F.floor(minute / 60)


def _first_two(spots: Column) -> Column:
    return F.slice(spots, 1, 2)


def _last_two(spots: Column) -> Column:
    return F.slice(spots, F.greatest(F.size(spots) - 1, F.lit(1)), 2)


def _around(spots: Column, first: Column, after: Column) -> Column:
    """Of sorted spots those from minute ``first`` to before ``after``, and the two on either side."""
    before = F.filter(spots, lambda s: s["minute"] < first)
    own = F.filter(spots, lambda s: (s["minute"] >= first) & (s["minute"] < after))
    later = F.filter(spots, lambda s: s["minute"] >= after)
    return F.concat(_last_two(before), own, _first_two(later))


def spots_by_hour(minutes: DataFrame, asked: DataFrame, all_without_time: bool = True) -> DataFrame:
    """For every zone of a vehicle and anchor and every hour of ``asked`` the spots that can be nearest in that hour.

    ``asked`` has the list of hours of each key that has trips; visits of other keys are left out. A half-day has a bounded
    number of minutes, whatever the number of visits, so a zone is one sorted list that is swept once per hour: the spots of
    the hour, and the two before and after it, carried from other hours where it has none. No list of an hour is longer
    than 64. Without a planned time all spots are kept, or the first.
    """
    zones = minutes.join(asked, MATCH_KEY).groupBy(*MATCH_KEY, *PLACE)
    swept = zones.agg(
        F.array_sort(F.collect_list("spot")).alias("spots"), F.sum("n").alias("n_visits"), F.first("hours").alias("hours")
    )
    hour, spots = F.col("hour"), F.col("spots")
    near = F.when(hour != NO_HOUR, _around(spots, hour * 60, hour * 60 + 60)).otherwise(
        spots if all_without_time else F.slice(spots, 1, 1)
    )
    by_hour = swept.withColumn("hour", F.explode("hours"))
    return by_hour.select(*MATCH_KEY, *PLACE, "hour", near.alias("spots"), "n_visits")


def _gap(spot: Column, expected_micros: Column) -> Column:
    """Whole minutes from a planned time to the nearest visit of a minute; 0 inside it, where all are under a minute."""
    after, before = spot["first_micros"] - expected_micros, expected_micros - spot["last_micros"]
    return F.floor(F.greatest(after, before, F.lit(0)) / MICROS_PER_MINUTE).cast("int")


def match_visits(
    trips: DataFrame, visits: DataFrame, all_without_time: bool = True, every_visit: bool = True
) -> DataFrame:
    """One row per distinct trip and zone (and category) visited by its vehicle at its anchor.

    ``gap`` is the number of whole minutes to the nearest visit, null without a planned time. ``near`` lists the minutes
    with visits at that gap; without a planned time all of them, or the first. Each has all its visits, or without
    ``every_visit`` the first and the last one.

    The visits are read and shuffled once. Trips meet the spots by vehicle, anchor, half-day and hour, so a key with very
    many trips is spread over the hours, and AQE can split what is left of it. Of a planned minute only the spots in it and
    the two minutes before and after it count: whole-minute gaps that are equal come from two neighbouring minutes.
    """
    planned, micros = F.col("planned_minute"), F.col("planned_micros")
    keyed = _with_keys(trips.select(*TRIP_KEY, *HALF_DAY).distinct()).withColumns(
        {
            "planned_minute": _minute("expected_time"),
            "planned_micros": micros_of_day(F.col("expected_time"), F.col("effective_date")),
            "hour": F.coalesce(_hour(_minute("expected_time")), F.lit(NO_HOUR)),
        }
    )
    asked = keyed.groupBy(*MATCH_KEY).agg(F.collect_set("hour").alias("hours"))
    minutes = minutes_with_every_visit(visits) if every_visit else minutes_with_visits(visits)
    paired = keyed.join(spots_by_hour(minutes, asked, all_without_time), [*MATCH_KEY, "hour"])
    paired = paired.withColumn("spots", F.when(planned.isNull(), F.col("spots")).otherwise(_around(F.col("spots"), planned, planned + 1)))
    gap = F.when(micros.isNotNull(), F.array_min(F.transform("spots", lambda s: _gap(s, micros))))
    near = F.filter("spots", lambda s: micros.isNull() | (_gap(s, micros) == F.col("gap")))
    matches = paired.withColumn("gap", gap).withColumn("near", near)
    return matches.select(*TRIP_KEY, *HALF_DAY, *PLACE, "near", "n_visits", "gap")


def _best_of_group(matches: DataFrame) -> DataFrame:
    """Matches with the least gap of their zone, vehicle, route and half-day; those without a gap come last.

    The rank limit is applied before the shuffle, so of a route with very many matches only those that tie in a map
    task are moved.
    """
    group = Window.partitionBy("zone", "rp_vehicle", "rp_route", *HALF_DAY).orderBy(F.col("gap").asc_nulls_last())
    return matches.withColumn("__rank", F.rank().over(group)).filter(F.col("__rank") == 1).drop("__rank")


def _result(found: DataFrame) -> DataFrame:
    delay = delay_minutes(F.col("expected_time"), F.col("gps_time"))
    return found.select(
        *TRIP_KEY, *HALF_DAY, "zone", "gps_time", delay.alias("gps_delay"), "gps_category", "gps_duration"
    )


def _times(n: Column) -> Column:
    """An array of ``n`` entries for ``explode``, in blocks so that a very large n needs no array of that size."""
    return F.transform(F.sequence(F.lit(0), F.floor((n - 1) / COPIES)), lambda b: F.least(n - b * COPIES, F.lit(COPIES)))


def closest_visits(trips: DataFrame, visits: DataFrame) -> DataFrame:
    """Per zone, vehicle, route and half-day the visits with the least absolute delay, ties included.

    Trips without a planned time count only where their group has no other; then every visit ties. The ties come from the
    match itself, so visits are not read again.
    """
    best = _best_of_group(match_visits(trips, visits).drop("n_visits"))
    minutes = best.withColumn("spot", F.explode("near")).drop("near")
    found = minutes.withColumn("visit", F.explode("spot.visits")).drop("spot")
    found = found.withColumns({"gps_time": F.col("visit.gps_time"), "gps_duration": F.col("visit.gps_duration")})
    delay = delay_minutes(F.col("expected_time"), F.col("gps_time"))
    tied = found.filter(F.col("gap").isNull() | (F.abs(delay) == F.col("gap")))
    block = tied.withColumn("block", F.explode(_times(F.col("visit.n"))))
    return _result(block.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("block")))))


def nearest_visits(trips: DataFrame, visits: DataFrame) -> DataFrame:
    """Those of the closest visits that a report can pick.

    Per trip, zone and minute only one is left: the first in minutes after the planned one and in the planned minute
    itself, the last in minutes before it; without a planned time the first of all. ``one_per_route`` prefers exactly
    these, so the pick is the same as from all ties.
    """
    matches = match_visits(trips, visits, all_without_time=False, every_visit=False).drop("n_visits")
    spots = _best_of_group(matches).withColumn("spot", F.explode("near"))
    earlier = F.col("spot.minute") < _minute("expected_time")
    return _result(
        spots.withColumns(
            {
                "gps_time": F.when(earlier, F.col("spot.last")).otherwise(F.col("spot.first")),
                "gps_duration": F.when(earlier, F.col("spot.last_duration")).otherwise(F.col("spot.first_duration")),
            }
        )
    )


def clock_minutes_apart(ts: str) -> Column:
    """Number of clock minutes between the planned minute and that of ``ts``."""
    return F.abs(_minute(ts) - _minute("expected_time"))


def micros_apart(ts: str) -> Column:
    """Microseconds between the planned time and ``ts``; 0 within the same clock minute."""
    micros = F.abs(micros_between(F.col("expected_time"), F.col(ts)))
    return F.when(clock_minutes_apart(ts) > 0, micros).otherwise(F.when(F.col(ts).isNotNull(), 0))
