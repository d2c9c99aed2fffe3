"""DuckDB statements that compute each registered query by plain joins over whole tables, for the result check."""

from __future__ import annotations

from kerbside.plans.daily_rates import RATE_HEADINGS
from kerbside.sources.derived import DERIVED_SQL, with_list


def _squish(column: str) -> str:
    return rf"trim(regexp_replace({column}, '[\s\p{{Z}}]+', ' ', 'g'))"


def _minutes(start: str, end: str) -> str:
    return f"CAST(trunc((epoch_us({end}) - epoch_us({start})) / 60000000.0) AS INT)"


def _same(left: str, right: str, *columns: str) -> str:
    return " AND ".join(f"{left}.{c} IS NOT DISTINCT FROM {right}.{c}" for c in columns)


_EXCLUDED = """CASE WHEN actual_load = 0 AND route_set_name <> 'CHARLESTOWN HS Combo AM' THEN true
 WHEN regexp_matches(route_set_name, '(?i)boston ballet') THEN true
 WHEN regexp_matches(route_set_name, '(?i)strive.*shuttle') THEN true
 WHEN regexp_matches(route_set_name, '(?i)horace mann afterschool pm') THEN true
 WHEN regexp_matches(route_set_name, '(?i)fsb bos collab all day') THEN true ELSE false END"""



def _nearness(ts: str) -> str:
    def minute(t: str) -> str:
        return f"floor((epoch_us({t}) - epoch_us(CAST(c.effective_date AS TIMESTAMP))) / 60000000.0)"

    apart = f"abs({minute(ts)} - {minute('expected_time')})"
    micros = f"CASE WHEN {apart} > 0 THEN abs(epoch_us({ts}) - epoch_us(expected_time)) WHEN {ts} IS NOT NULL THEN 0 END"
    return f"{apart} ASC NULLS LAST, {micros} ASC NULLS LAST, {ts} ASC NULLS LAST"


_PICK_ORDER = f"""(delay_combined > -10) ASC NULLS LAST, arrival_in_window DESC NULLS LAST,
 abs(delay_combined) ASC NULLS LAST, {_nearness("arrival")}, c.rp_vehicle ASC NULLS LAST,
 anchor_abbrev ASC NULLS LAST, zone ASC NULLS LAST, expected_time ASC NULLS LAST, {_nearness("gps_time")},
 gps_category ASC NULLS LAST, gps_duration ASC NULLS LAST, actual_time ASC NULLS LAST, delay_time ASC NULLS LAST,
 overnight_garage ASC NULLS LAST, route_set_name ASC NULLS LAST, route_name ASC NULLS LAST,
 actual_load ASC NULLS LAST, days ASC NULLS LAST, original_rp_vehicle ASC NULLS LAST"""

_HALF_DAY = ("effective_date", "direction")
_MATCHED = ("rp_vehicle", "anchor_abbrev")
_REPORT = """rp_vehicle, rp_route, expected_time, arrival, delay_combined, actual_time, gps_time, delay_time, gps_delay,
 direction, anchor_abbrev, date, ampm, overnight_garage, names, route_name, actual_load, days, route_set_name, excluded,
 original_rp_vehicle, zone, gps_category, gps_duration, in_gps, in_system, arrival_source, arrival_in_window,
 zone_known, vehicle_override, uncovered, cutoff_min, cutoff_max, trip_category"""


def _chosen(source: str) -> str:
    g, s, lo, hi = "gps_delay", "delay_time", -25, 60
    return f"""
SELECT *, gps_time IS NOT NULL AS in_gps, actual_time IS NOT NULL AS in_system,
 CASE WHEN arrival = gps_time THEN 'GPS' WHEN arrival = actual_time THEN 'Schedule' END AS arrival_source,
 {_minutes("expected_time", "arrival")} AS delay_combined,
 {_minutes("expected_time", "arrival")} > {lo} AND {_minutes("expected_time", "arrival")} < {hi} AS arrival_in_window
FROM (SELECT *, coalesce(CASE
 WHEN {g} > -10 AND {g} < {hi} AND ({s} < -10 OR {s} > {hi}) THEN gps_time
 WHEN {s} > -10 AND {s} < {hi} AND ({g} < -10 OR {g} > {hi}) THEN actual_time
 WHEN {g} > {lo} AND {g} < {hi} AND ({s} < {lo} OR {s} > {hi}) THEN gps_time
 WHEN {s} > {lo} AND {s} < {hi} AND ({g} < {lo} OR {g} > {hi}) THEN actual_time
 WHEN abs({s}) < abs({g}) THEN actual_time ELSE gps_time END, gps_time, actual_time) AS arrival
 FROM {source})"""


def _report(candidates: str) -> str:
    """Overrides, pick, uncovered list and category on top of a CTE of candidates with a chosen arrival."""
    return f"""
SELECT {_REPORT}, listed_uncovered FROM (
SELECT *, effective_date AS date, listed AND NOT (in_gps OR in_system) AS uncovered, listed AS listed_uncovered,
 CAST(-25 AS DOUBLE) AS cutoff_min, CAST(60 AS DOUBLE) AS cutoff_max,
 CASE WHEN excluded THEN 'Excluded' WHEN listed AND NOT (in_gps OR in_system) THEN 'Uncovered'
 WHEN NOT arrival_in_window THEN 'Arrived outside window' WHEN delay_combined IS NOT NULL THEN 'Reported'
 ELSE 'Unreported' END AS trip_category
FROM (
SELECT p.* EXCLUDE (overnight_garage, original_rp_vehicle), regexp_replace(p.overnight_garage, ' .*$', '') AS overnight_garage,
 p.original_rp_vehicle IS NOT NULL AS vehicle_override, coalesce(p.original_rp_vehicle, p.rp_vehicle) AS original_rp_vehicle,
 coalesce(u.uncovered, false) AS listed,
 coalesce(p.anchor_abbrev IN (SELECT anchor_abbrev FROM zone_anchor), false) AS zone_known
FROM (
SELECT * FROM (SELECT c.*, o.original_rp_vehicle,
 row_number() OVER (PARTITION BY c.rp_route, c.effective_date, c.direction ORDER BY {_PICK_ORDER}) AS pick
 FROM {candidates} c LEFT JOIN override_clean o ON {_same("c", "o", "rp_route", "rp_vehicle", "effective_date")}) WHERE pick = 1) p
LEFT JOIN uncovered_clean u ON coalesce(p.original_rp_vehicle, p.rp_vehicle) IS NOT DISTINCT FROM u.rp_vehicle
 AND p.ampm IS NOT DISTINCT FROM u.ampm AND p.route_set_name IS NOT DISTINCT FROM u.route_set_name AND p.effective_date = u.date
))"""


_FLAGS = {
    "on_time_by_anchor": 0, "within_5_min": 5, "within_10_min": 10, "true_on_time": 15, "late_10_min": 25,
    "late_15_min": 30, "late_25_min": 40, "late_30_min": 45,
}
_FLAG_COLUMNS = ",\n ".join(
    f"CASE WHEN uncovered OR delay_combined > {k} THEN 0.0::DOUBLE WHEN NOT (uncovered OR delay_combined > {k}) THEN 1.0::DOUBLE END AS {n}"
    for n, k in _FLAGS.items()
)
_MINUTE_OF_DAY = "round_even((epoch_us(expected_time) - epoch_us(CAST(date AS TIMESTAMP))) / 60000000.0, 0)"
_TIER = f"CASE WHEN {_MINUTE_OF_DAY} < 451 THEN '7:30' WHEN {_MINUTE_OF_DAY} < 511 THEN '8:30' WHEN {_MINUTE_OF_DAY} < 651 THEN '9:30' ELSE '' END"
_US_DATE = "strftime(date, '%m/%d/%Y')"

_RATES = {
    "otp_am": ("ampm = 'AM'", "true_on_time"),
    "otp_pm": ("ampm = 'PM'", "within_10_min"),
    "am_tier_730": ("time_tier = '7:30'", "true_on_time"),
    "am_tier_830": ("time_tier = '8:30'", "true_on_time"),
    "am_tier_930": ("time_tier = '9:30'", "true_on_time"),
    "am_yard_read": ("ampm = 'AM' AND yard = 'Read'", "true_on_time"),
    "am_yard_wash": ("ampm = 'AM' AND yard = 'Wash'", "true_on_time"),
    "am_yard_frpt": ("ampm = 'AM' AND yard = 'Frpt'", "true_on_time"),
    "am_within_anchor": ("ampm = 'AM'", "on_time_by_anchor"),
    "am_within_15_of_on_time": ("ampm = 'AM'", "late_15_min"),
    "am_within_30_of_school_time": ("ampm = 'AM'", "late_30_min"),
    "pm_yard_read": ("ampm = 'PM' AND yard = 'Read'", "within_10_min"),
    "pm_yard_wash": ("ampm = 'PM' AND yard = 'Wash'", "within_10_min"),
    "pm_yard_frpt": ("ampm = 'PM' AND yard = 'Frpt'", "within_10_min"),
    "pm_within_anchor": ("ampm = 'PM'", "on_time_by_anchor"),
    "pm_within_15_of_on_time": ("ampm = 'PM'", "late_10_min"),
    "pm_within_30_of_school_time": ("ampm = 'PM'", "late_25_min"),
}


def _enriched(side: str) -> str:
    return f"""
SELECT r.*, v.vehicle, v.overnight_garage AS yard, s.route_set_name AS route_set FROM route_{side} r
LEFT JOIN vehicle_{side} v ON r.vehicle_id IS NOT DISTINCT FROM v.record_id
LEFT JOIN route_set_{side} s ON r.route_set_id IS NOT DISTINCT FROM s.route_set_id"""


def _stops(side: str) -> str:
    return f"""
SELECT DISTINCT visible_route_id, request_type, origin_point_id, destination_point_id,
 CASE request_type WHEN 'I' THEN destination_point_id WHEN 'O' THEN origin_point_id END AS anchor_point,
 CASE request_type WHEN 'I' THEN origin_point_id WHEN 'O' THEN destination_point_id END AS non_anchor_point
FROM (SELECT r.visible_route_id, q.request_type,
 CASE WHEN q.request_type = 'O' THEN r.origin_point_id ELSE q.origin_point_id END AS origin_point_id,
 CASE WHEN q.request_type = 'I' THEN r.destination_point_id ELSE q.destination_point_id END AS destination_point_id
 FROM request_{side} q JOIN satisfaction_{side} s ON q.record_id IS NOT DISTINCT FROM s.trex_id
 JOIN route_detail_{side} d ON s.pickup_route_detail_id IS NOT DISTINCT FROM d.record_id
 LEFT JOIN route_{side} r ON d.route_id IS NOT DISTINCT FROM r.record_id)"""


def _anchored_route(side: str, fixed: bool = False) -> str:
    other = " WHEN r.anchor_time_at_origin = 'N' THEN r.destination_point_id" if fixed else ""
    anchor = f"CASE WHEN r.anchor_time_at_origin = 'Y' THEN r.origin_point_id{other} END"
    return f"""
SELECT r.*, {anchor} AS anchor_point_id, p.stop_description AS anchor_location FROM enriched_{side} r
LEFT JOIN point_text_{side} p ON {anchor} IS NOT DISTINCT FROM p.record_id"""


def _hms(column: str) -> str:
    return f"printf('%02d:%02d:%02d', CAST({column} // 3600 AS INT), CAST({column} % 3600 // 60 AS INT), CAST({column} % 60 AS INT))"


_VARIABLES = [
    ("route", "Route"), ("direction", "Direction"), ("route_name", "RouteName"), ("route_set", "RouteSet"),
    ("days", "Days"), ("anchor_location", "AnchorLocation"), ("anchor_time", "AnchorTime"), ("vehicle", "Vehicle"),
    ("yard", "Yard"), ("stops", "Stops"), ("desired_load", "DesiredLoad"), ("actual_load", "ActualLoad"),
    ("route_distance", "RouteDistance"), ("route_time", "RouteTime"),
]


def _diff(fixed: bool = False) -> str:
    parts = [
        "coalesce(o.visible_route_id, n.visible_route_id) AS visible_route_id",
        "CAST((n.record_id IS NOT NULL AND o.record_id IS NULL) OR (o.record_id IS NOT NULL AND n.record_id IS NULL) AS INT) AS route_diff",
        "CASE WHEN n.record_id IS NOT NULL AND o.record_id IS NULL THEN CAST(n.record_id AS STRING) ELSE '' END AS route_added",
        "CASE WHEN o.record_id IS NOT NULL AND n.record_id IS NULL THEN CAST(o.record_id AS STRING) ELSE '' END AS route_removed",
    ]

    def put(name: str, diff: str, shown: str, added: str, removed: str) -> None:
        parts.append(f"{diff} AS {name}_diff")
        parts.append(f"CASE WHEN {shown} THEN {added} ELSE '' END AS {name}_added")
        parts.append(f"CASE WHEN {shown} THEN {removed} ELSE '' END AS {name}_removed")

    def code(side: str) -> str:
        return f"CASE {side}.anchor_time_at_origin WHEN 'N' THEN 'I' WHEN 'Y' THEN 'O' END"

    after = code("n" if fixed else "o")
    put("direction", f"CAST({after} <> {code('o')} AS INT)", f"{after} <> {code('o')}", after, code("o"))
    for name, key, text in (
        ("route_name", "name", "name"), ("route_set", "route_set_id", "route_set"), ("days", "days", "days"),
        ("anchor_location", "anchor_point_id", "anchor_location"), ("vehicle", "vehicle", "vehicle"),
        ("yard", "yard", "yard"),
    ):
        put(name, f"CAST(n.{key} <> o.{key} AS INT)", f"n.{key} <> o.{key}", f"n.{text}", f"o.{text}")
    put("anchor_time", "n.anchor_time_s - o.anchor_time_s", "n.anchor_time_s > o.anchor_time_s",
        _hms("n.anchor_time_s"), _hms("o.anchor_time_s"))
    parts += [
        "coalesce(c.n_stops_changed, 0) AS stops_diff",
        "coalesce(c.stops_added, '') AS stops_added",
        "coalesce(c.stops_removed, '') AS stops_removed",
    ]
    put("desired_load", "n.desired_load - o.desired_load", "n.desired_load > o.desired_load",
        "CAST(n.desired_load AS STRING)", "CAST(o.desired_load AS STRING)")
    for name, column, limit in (
        ("actual_load", "actual_load", 5), ("route_distance", "route_distance", 100), ("route_time", "route_time_s", 180),
    ):
        put(name, f"n.{column} - o.{column}", f"abs(n.{column} - o.{column}) > {limit}",
            f"CAST(n.{column} AS STRING)", f"CAST(o.{column} AS STRING)")
    kind = "fixed" if fixed else "plain"
    amount = "abs({})" if fixed else "{}"
    total = " + ".join(amount.format(f"coalesce({v}_diff, 0)") for v, _ in _VARIABLES)
    return f"""
SELECT *, {total} > 0 AS any_change,
 coalesce(TRY_CAST(visible_route_id AS BIGINT) IN (SELECT route FROM old_rule), false) AS in_old_rule
FROM (SELECT {", ".join(parts)} FROM anchored_{kind}_pend o
FULL JOIN anchored_{kind}_plan n ON o.visible_route_id IS NOT DISTINCT FROM n.visible_route_id
LEFT JOIN stop_change c ON coalesce(o.visible_route_id, n.visible_route_id) IS NOT DISTINCT FROM c.visible_route_id)"""


def _long(diffs: str) -> str:
    return " UNION ALL ".join(
        f"SELECT visible_route_id, {i} AS position, '{p}' AS variable, CAST({v}_diff AS DOUBLE) AS diff, {v}_added AS added,"
        f" {v}_removed AS removed FROM {diffs} WHERE any_change"
        for i, (v, p) in enumerate(_VARIABLES)
    )


def _notes(long: str) -> str:
    return f"""
SELECT visible_route_id, string_agg(concat(variable, ' ', coalesce(removed, 'NA'), ' => ', coalesce(added, 'NA')), chr(59) || chr(10) ORDER BY position) AS notes
FROM {long} WHERE added <> '' OR removed <> '' GROUP BY visible_route_id"""


_DAYS, _SHIFTS = "MTWHF", ("Pickup", "Dropoff")
_WIDE = ", ".join(
    f"max(CASE WHEN day = '{d}' AND shift = '{s}' THEN {v} END) AS {d.lower()}_{s.lower()}_{v}"
    for d in _DAYS
    for s in _SHIFTS
    for v in ("route", "bus")
)

_STEPS: dict[str, str] = {
    "anchored": f"SELECT {_squish('name')} AS name, {_squish('anchor_abbrev')} AS anchor_abbrev FROM building WHERE anchor_abbrev <> ''",
    "anchor_names": "SELECT anchor_abbrev, coalesce(string_agg(name, '; ' ORDER BY name), '') AS names FROM (SELECT DISTINCT anchor_abbrev, name FROM anchored) GROUP BY anchor_abbrev",
    "set_clean": f"SELECT route_set_id, {_squish('route_set_name')} AS route_set_name FROM route_set",
    "routes_named": f"""SELECT rp_route, {_squish('route_name')} AS route_name, actual_load, days, route_set_name,
 upper(nullif(regexp_extract(route_set_name, '(?i)\\b(AM|PM)\\b', 0), '')) AS ampm, {_EXCLUDED} AS excluded
 FROM route r LEFT JOIN set_clean s ON r.route_set_id IS NOT DISTINCT FROM s.route_set_id""",
    "override_clean": f"SELECT DISTINCT effective_date, {_squish('rp_route')} AS rp_route, {_squish('rp_vehicle')} AS rp_vehicle, {_squish('original_rp_vehicle')} AS original_rp_vehicle FROM vehicle_override",
    "uncovered_clean": f"SELECT date, {_squish('upper(ampm)')} AS ampm, {_squish('route_set')} AS route_set_name, {_squish('bus')} AS rp_vehicle, true AS uncovered FROM uncovered",
    "trips_pm": f"""SELECT t.rp_route, t.rp_vehicle, t.anchor_abbrev, t.effective_date, t.direction, l.planned_time AS expected_time,
 l.actual_time, t.delay_time, t.overnight_garage FROM trip t LEFT JOIN (SELECT DISTINCT * FROM location_schedule) l
 ON {_same("t", "l", "rp_vehicle", "rp_route", "anchor_abbrev", "effective_date")} WHERE t.direction = 'O'""",
    "trips_both": "SELECT * FROM trip WHERE direction = 'I' UNION ALL SELECT * FROM trips_pm",
    "trips_squished": f"""SELECT {_squish('rp_route')} AS rp_route, {_squish('rp_vehicle')} AS rp_vehicle, {_squish('anchor_abbrev')} AS anchor_abbrev,
 effective_date, direction, CAST(effective_date AS TIMESTAMP) + (expected_time - date_trunc('day', expected_time)) AS expected_time,
 actual_time, delay_time, {_squish('overnight_garage')} AS overnight_garage FROM trips_both""",
    "trips_anchored": """SELECT * REPLACE (CASE WHEN anchor_abbrev IN (SELECT anchor_abbrev FROM anchored) THEN anchor_abbrev
 ELSE substr(anchor_abbrev, 1, 4) END AS anchor_abbrev) FROM trips_squished""",
    "trips_clean": """SELECT t.*, a.names, n.* EXCLUDE (rp_route, excluded), coalesce(n.excluded, false) AS excluded FROM trips_anchored t
 LEFT JOIN anchor_names a ON t.anchor_abbrev IS NOT DISTINCT FROM a.anchor_abbrev
 LEFT JOIN routes_named n ON t.rp_route IS NOT DISTINCT FROM n.rp_route""",
    "windows": """SELECT effective_date, direction, min(expected_time) - INTERVAL '30' MINUTE AS start_time, max(expected_time) + INTERVAL '30' MINUTE AS end_time
 FROM trips_clean WHERE NOT excluded GROUP BY effective_date, direction""",
    "categories": f"SELECT DISTINCT {_squish('category')} AS category, {_squish('type')} AS type FROM zone",
    "visits_kept": f"""SELECT v.asset, v.zone, v.category, v.time_in, v.duration_s, w.effective_date, w.direction
 FROM (SELECT {_squish('asset')} AS asset, {_squish('zone')} AS zone, {_squish('category')} AS category, time_in, duration_s FROM zone_visit) v
 JOIN windows w ON v.time_in BETWEEN w.start_time AND w.end_time
 WHERE NOT coalesce(v.category IN (SELECT category FROM categories WHERE type = 'other'), false)""",
    "visits_placed": """SELECT v.asset AS rp_vehicle, a.anchor_abbrev, v.zone, v.effective_date, v.direction, v.time_in AS gps_time,
 v.category AS gps_category, v.duration_s AS gps_duration FROM visits_kept v LEFT JOIN anchored a ON v.zone IS NOT DISTINCT FROM a.name""",
    "zone_anchor": f"SELECT DISTINCT a.anchor_abbrev FROM zone z JOIN anchored a ON {_squish('z.name')} IS NOT DISTINCT FROM a.name",
    "pairs": f"""SELECT t.*, v.zone, v.gps_time, {_minutes('t.expected_time', 'v.gps_time')} AS gps_delay, v.gps_category, v.gps_duration
 FROM (SELECT DISTINCT rp_vehicle, anchor_abbrev, rp_route, expected_time, effective_date, direction FROM trips_clean) t
 JOIN visits_placed v ON {_same("t", "v", *_MATCHED, *_HALF_DAY)}""",
    "closest": """SELECT * EXCLUDE (place) FROM (SELECT *, rank() OVER (PARTITION BY zone, rp_vehicle, rp_route, effective_date, direction
 ORDER BY abs(gps_delay) ASC NULLS LAST) AS place FROM pairs) WHERE place = 1""",
    "joined": f"""SELECT t.*, c.zone, c.gps_time, c.gps_delay, c.gps_category, c.gps_duration FROM trips_clean t
 LEFT JOIN closest c ON {_same("t", "c", *_MATCHED, "rp_route", "expected_time", *_HALF_DAY)}""",
    "unmatched": """SELECT *, CAST(NULL AS STRING) AS zone, CAST(NULL AS TIMESTAMP) AS gps_time, CAST(NULL AS INT) AS gps_delay,
 CAST(NULL AS STRING) AS gps_category, CAST(NULL AS DOUBLE) AS gps_duration FROM trips_clean""",
    "chosen": _chosen("joined"),
    "chosen_no_visits": _chosen("unmatched"),
    "report": _report("chosen"),
    "report_no_visits": _report("chosen_no_visits"),
    "raw": f"""SELECT {_US_DATE} AS date, concat(coalesce(rp_route, 'NA'), ': ', {_US_DATE}) AS route_date,
 CAST(trunc(TRY_CAST(rp_route AS DOUBLE)) AS INT) AS route, rp_vehicle AS vehicle, anchor_abbrev AS anchor_location, '' AS planned_start_time,
 strftime(expected_time, '%H:%M') AS planned_anchor_time, strftime(arrival, '%H:%M') AS actual_arrival_time,
 delay_combined AS delay_minutes, {_FLAG_COLUMNS}, ampm, {_TIER} AS time_tier, substr(rp_vehicle, 1, 1) AS type_of_bus,
 concat(coalesce(rp_vehicle, 'NA'), ': ', {_US_DATE}) AS bus_day,
 CASE overnight_garage WHEN 'FREEPORT' THEN 'Frpt' WHEN 'READVILLE' THEN 'Read' WHEN 'WASHINGTON' THEN 'Wash' END AS yard,
 '' AS x_1, '' AS x_2, {_MINUTE_OF_DAY} AS anchor_time_converted, '' AS x_5, uncovered, excluded FROM report""",
    "summary": "SELECT date AS otp_date, "
    + ", ".join(f"avg(CASE WHEN NOT excluded AND {c} THEN {f} END) AS {n}" for n, (c, f) in _RATES.items())
    + " FROM raw GROUP BY date",
    "covered": "SELECT * FROM report WHERE listed_uncovered AND (in_system OR in_gps)",
    **{
        f"point_text{side}": f"SELECT record_id, coalesce(nullif(custom_description, ''), description) AS stop_description FROM point{side}"
        for side in ("", "_pend", "_plan")
    },
    "enriched_pend": _enriched("pend"),
    "enriched_plan": _enriched("plan"),
    "stops_pend": _stops("pend"),
    "stops_plan": _stops("plan"),
    "described_pend": "SELECT s.*, p.stop_description FROM stops_pend s LEFT JOIN point_text_pend p ON s.non_anchor_point IS NOT DISTINCT FROM p.record_id",
    "described_plan": "SELECT s.*, p.stop_description FROM stops_plan s LEFT JOIN point_text_plan p ON s.non_anchor_point IS NOT DISTINCT FROM p.record_id",
    "stops_all": f"""SELECT coalesce(o.visible_route_id, n.visible_route_id) AS visible_route_id, o.stop_description AS old_text,
 n.stop_description AS new_text, coalesce(o.there, false) AS in_pending, coalesce(n.there, false) AS in_planning
 FROM (SELECT *, true AS there FROM described_pend) o FULL JOIN (SELECT *, true AS there FROM described_plan) n
 ON {_same("o", "n", "visible_route_id", "non_anchor_point")}""",
    "stop_change": """SELECT visible_route_id,
 coalesce(string_agg(CASE WHEN NOT in_planning THEN coalesce(old_text, 'NA') END, ' :: ' ORDER BY coalesce(old_text, 'NA')), '') AS stops_removed,
 coalesce(string_agg(CASE WHEN NOT in_pending THEN coalesce(new_text, 'NA') END, ' :: ' ORDER BY coalesce(new_text, 'NA')), '') AS stops_added,
 CAST(count(*) FILTER (NOT in_planning) AS INT) AS n_stops_removed, CAST(count(*) FILTER (NOT in_pending) AS INT) AS n_stops_added,
 CAST(count(*) AS INT) AS n_stops_changed FROM stops_all WHERE NOT in_pending OR NOT in_planning GROUP BY visible_route_id""",
    "anchored_plain_pend": _anchored_route("pend"),
    "anchored_plain_plan": _anchored_route("plan"),
    "anchored_fixed_pend": _anchored_route("pend", True),
    "anchored_fixed_plan": _anchored_route("plan", True),
    "old_rule": """SELECT n.record_id AS route, n.vehicle AS bus FROM enriched_plan n LEFT JOIN enriched_pend o ON n.record_id = o.record_id
 WHERE coalesce(n.vehicle, '') <> '' AND (coalesce(n.vehicle, '') <> coalesce(o.vehicle, '')
 OR coalesce(abs(n.actual_load - coalesce(o.actual_load, 0)) >= 5, false)
 OR coalesce(abs(trunc(n.route_time_s / 60) - trunc(o.route_time_s / 60)) >= 3, false))""",
    "diffs": _diff(),
    "diffs_fixed": _diff(fixed=True),
    "long_changes": _long("diffs"),
    "long_changes_fixed": _long("diffs_fixed"),
    "notes": _notes("long_changes"),
    "notes_fixed": _notes("long_changes_fixed"),
    "wide": f"SELECT record_id, program_description, {_WIDE} FROM monitor GROUP BY record_id, program_description",
    "ovr_trips": f"""SELECT t.*, o.original_rp_vehicle IS NOT NULL AS vehicle_override, coalesce(o.original_rp_vehicle, t.rp_vehicle) AS original_rp_vehicle
 FROM trip t LEFT JOIN override_clean o ON {_same("t", "o", "rp_route", "rp_vehicle", "effective_date")}""",
}

_TABLES = {**DERIVED_SQL, **_STEPS}


def _updated_history(headings: dict[str, str]) -> str:
    """The history with the rates of the summary's dates; other rows stay. ``headings``: name of each result column."""
    held = {"otp_am": "h.otp_am", "otp_pm": "h.otp_pm"}
    rates = ", ".join(
        f"round(CASE WHEN s.otp_date IS NOT NULL THEN s.{n} ELSE {held.get(n, 'NULL')} END, 6) AS \"{headings[n]}\"" for n in _RATES
    )
    return f"""SELECT h.otp_date AS "{headings['otp_date']}", {rates} FROM history h LEFT JOIN summary s ON strftime(h.otp_date, '%m/%d/%Y') = s.otp_date"""



_FINAL: dict[str, str] = {
    "otp_scan": "SELECT * FROM trip WHERE direction = 'I' AND effective_date IS NOT NULL",
    "uncovered_norm": "SELECT * FROM uncovered_clean",
    "zone_categories": "SELECT * FROM categories",
    "zone_visits_window": "SELECT * FROM visits_kept",
    "zone_visits_dated": "SELECT * FROM visits_kept",
    "service_window": "SELECT * FROM windows",
    "squish": f"SELECT {_squish('name')} AS name, {_squish('anchor_abbrev')} AS anchor_abbrev FROM building",
    "building_anchor": "SELECT * FROM anchored",
    "building_names": "SELECT * FROM anchor_names",
    "expected_rebase": "SELECT rp_route, rp_vehicle, effective_date, expected_time, CAST(effective_date AS TIMESTAMP) + (expected_time - date_trunc('day', expected_time)) AS rebased_time FROM trip",
    "anchor_fallback": "SELECT rp_route, rp_vehicle, effective_date, CASE WHEN anchor_abbrev IN (SELECT anchor_abbrev FROM anchored) THEN anchor_abbrev ELSE substr(anchor_abbrev, 1, 4) END AS anchor_abbrev FROM trip",
    "ampm_extract": r"SELECT route_set_id, route_set_name, upper(nullif(regexp_extract(route_set_name, '(?i)\b(AM|PM)\b', 0), '')) AS ampm FROM set_clean",
    "exclusion_flag": "SELECT rp_route, route_set_name, actual_load, excluded FROM routes_named",
    "route_named": "SELECT t.rp_route, t.rp_vehicle, t.effective_date, t.direction, n.route_name, n.actual_load, n.days, n.route_set_name, n.ampm FROM trip t LEFT JOIN routes_named n ON t.rp_route IS NOT DISTINCT FROM n.rp_route",
    "delay_minutes": f"SELECT rp_route, rp_vehicle, effective_date, expected_time, actual_time, {_minutes('expected_time', 'actual_time')} AS delay FROM trip",
    "garage_short": "SELECT rp_vehicle, rp_route, overnight_garage, regexp_replace(overnight_garage, ' .*$', '') AS garage FROM trip",
    "pm_schedule": "SELECT * FROM trips_pm",
    "vehicle_override": "SELECT * FROM ovr_trips",
    "visit_anchor": "SELECT asset, zone, category, time_in, duration_s, anchor_abbrev FROM (SELECT DISTINCT asset, zone, category, time_in, duration_s FROM zone_visit) v LEFT JOIN anchored a ON v.zone IS NOT DISTINCT FROM a.name",
    "zone_known": "SELECT rp_route, rp_vehicle, effective_date, direction, anchor_abbrev, coalesce(anchor_abbrev IN (SELECT anchor_abbrev FROM zone_anchor), false) AS zone_known FROM trips_anchored",
    "visit_match": "SELECT rp_vehicle, anchor_abbrev, rp_route, expected_time, effective_date, direction, zone, gps_category, count(*) AS n_visits, min(abs(gps_delay)) AS gap FROM pairs GROUP BY ALL",
    "closest_visit": "SELECT * FROM closest",
    "arrival_choice": "SELECT rp_route, rp_vehicle, anchor_abbrev, effective_date, direction, expected_time, zone, gps_time, gps_delay, actual_time, delay_time, arrival, arrival_source, delay_combined, arrival_in_window FROM chosen",
    "otp_report": f"SELECT {_REPORT} FROM report",
    "otp_no_visits": f"SELECT {_REPORT} FROM report_no_visits",
    "trip_category": "SELECT rp_route, date, direction, original_rp_vehicle, excluded, uncovered, delay_combined, trip_category FROM report",
    "uncovered_join": """SELECT t.rp_route, t.rp_vehicle, t.effective_date, t.original_rp_vehicle, n.ampm, n.route_set_name, coalesce(u.uncovered, false) AS uncovered
 FROM ovr_trips t LEFT JOIN routes_named n ON t.rp_route IS NOT DISTINCT FROM n.rp_route
 LEFT JOIN uncovered_clean u ON t.original_rp_vehicle IS NOT DISTINCT FROM u.rp_vehicle AND n.ampm IS NOT DISTINCT FROM u.ampm
 AND n.route_set_name IS NOT DISTINCT FROM u.route_set_name AND t.effective_date IS NOT DISTINCT FROM u.date""",
    "covered_trips": f"SELECT {_REPORT} FROM covered",
    "unreported_trips": f"SELECT {_REPORT} FROM report WHERE excluded OR (delay_combined IS NULL AND NOT uncovered)",
    "uncovered_reconcile": f"""SELECT l.*, EXISTS (SELECT 1 FROM covered c WHERE c.date = l.date AND c.ampm IS NOT DISTINCT FROM upper({_squish('l.ampm')})
 AND c.route_set_name IS NOT DISTINCT FROM {_squish('l.route_set')} AND c.original_rp_vehicle IS NOT DISTINCT FROM {_squish('l.bus')}) AS removed FROM uncovered l""",
    "uncovered_reconcile_any": """SELECT l.*, l.date IN (SELECT date FROM covered) AND l.ampm IN (SELECT ampm FROM covered WHERE ampm IS NOT NULL)
 AND l.route_set IN (SELECT route_set_name FROM covered WHERE route_set_name IS NOT NULL) AND l.bus IN (SELECT rp_vehicle FROM covered WHERE rp_vehicle IS NOT NULL) AS removed FROM uncovered l""",
    "lateness_flags": f"SELECT rp_route, date, direction, original_rp_vehicle, uncovered, delay_combined, {_FLAG_COLUMNS} FROM report",
    "time_tier": f"SELECT rp_route, rp_vehicle, effective_date AS date, expected_time, {_MINUTE_OF_DAY.replace('CAST(date', 'CAST(effective_date')} AS minutes, {_TIER.replace('CAST(date', 'CAST(effective_date')} AS time_tier FROM trips_squished",
    "prepare_raw": "SELECT * FROM raw",
    "prepare_raw_old": "SELECT * EXCLUDE (uncovered, excluded) FROM raw",
    "otp_summary": "SELECT otp_date, " + ", ".join(f"round({n}, 6) AS {n}" for n in _RATES) + " FROM summary",
    "history_merge": _updated_history({n: n for n in RATE_HEADINGS}),
    "history_headings": _updated_history(RATE_HEADINGS),
    "history_published": _updated_history({n: n for n in RATE_HEADINGS}),
    "fill_down": """SELECT event_id, user_id, ts, last_value(mark IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mark
 FROM (SELECT event_id, user_id, ts, CASE WHEN event_type IN ('purchase', 'signup') THEN event_type END AS mark FROM events)""",
    "stop_text": "SELECT * FROM point_text",
    "request_points": "SELECT * FROM stops_pend",
    "route_enriched": "SELECT * FROM enriched_pend",
    "route_anchor": "SELECT record_id, visible_route_id, anchor_time_at_origin, anchor_point_id, anchor_location FROM anchored_plain_pend",
    "stop_requests": "SELECT * FROM described_pend",
    "stop_presence": """SELECT visible_route_id, non_anchor_point, CAST(sum(o) AS BIGINT) AS n_pending, CAST(sum(n) AS BIGINT) AS n_planning FROM (
 SELECT visible_route_id, non_anchor_point, 1 AS o, 0 AS n FROM stops_pend UNION ALL SELECT visible_route_id, non_anchor_point, 0, 1 FROM stops_plan)
 GROUP BY visible_route_id, non_anchor_point""",
    "stop_changes": "SELECT * FROM stop_change",
    "stop_changes_stored": "SELECT * FROM stop_change",
    "old_change_rule": "SELECT * FROM old_rule",
    "in_old_rule": "SELECT visible_route_id, coalesce(TRY_CAST(visible_route_id AS BIGINT) IN (SELECT route FROM old_rule), false) AS in_old_rule FROM route_plan",
    "route_diff": "SELECT * FROM diffs",
    "route_diff_fixed": "SELECT * FROM diffs_fixed",
    "change_long": "SELECT * FROM long_changes",
    "change_notes": "SELECT * FROM notes",
    "tripchange_report": "SELECT d.*, n.notes FROM diffs d JOIN notes n ON d.visible_route_id IS NOT DISTINCT FROM n.visible_route_id WHERE d.any_change",
    "tripchange_fixed": "SELECT d.*, n.notes FROM diffs_fixed d JOIN notes_fixed n ON d.visible_route_id IS NOT DISTINCT FROM n.visible_route_id WHERE d.any_change",
    "monitor_wide": "SELECT * FROM wide",
    "monitor_long": " UNION ALL ".join(
        f"SELECT record_id, program_description, '{d}' AS day, '{s}' AS shift, {d.lower()}_{s.lower()}_route AS route, {d.lower()}_{s.lower()}_bus AS bus FROM wide"
        for d in _DAYS
        for s in _SHIFTS
    ),
}


def oracle_statements() -> dict[str, str]:
    out = {}
    for name, sql in _FINAL.items():
        ctes = with_list(sql, _TABLES)
        out[name] = f"WITH {ctes}\n{sql}" if ctes else sql
    return out
