"""Tables with the roles of the library's inputs, derived by SQL from the given test tables.

Each entry is one SELECT that gives the same rows in Spark and in DuckDB. It may name the base tables and
derived tables that stand before it. The schemas are listed in ``FIXTURES.md``.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

DERIVED_SQL: dict[str, str] = {
    "building": r"""
SELECT concat('SCHOOL  ', n_name, ' ') AS name, concat('N', lpad(CAST(n_nationkey AS STRING), 3, '0')) AS anchor_abbrev FROM nation
UNION ALL SELECT concat('ANNEX ', n_name), concat('N', lpad(CAST(n_nationkey AS STRING), 3, '0')) FROM nation WHERE n_nationkey % 5 = 0
UNION ALL SELECT 'NO ANCHOR', '' UNION ALL SELECT 'NULL ANCHOR', CAST(NULL AS STRING)
""",
    "trip": r"""
SELECT CAST(10000 + event_id % 120 AS STRING) AS rp_route, concat('B', CAST(user_id AS STRING)) AS rp_vehicle,
 CASE WHEN event_id % 99 <> 0 THEN concat('N', lpad(CAST(event_id % 25 AS STRING), 3, '0'), CASE WHEN event_id % 10 = 0 THEN '-2' ELSE '' END) END AS anchor_abbrev, CAST(ts AS DATE) AS effective_date,
 CASE WHEN extract(HOUR FROM ts) < 12 THEN 'I' ELSE 'O' END AS direction,
 ts + (CASE WHEN event_id % 15 = 0 THEN 40 ELSE event_id % 41 - 20 END) * INTERVAL '1' MINUTE AS expected_time,
 CASE WHEN event_id % 11 <> 0 THEN ts + (event_id % 7 - 3) * INTERVAL '1' MINUTE END AS actual_time,
 CASE WHEN event_id % 11 <> 0 THEN CAST((event_id % 7 - 3) - (CASE WHEN event_id % 15 = 0 THEN 40 ELSE event_id % 41 - 20 END) AS INT) END AS delay_time,
 CASE user_id % 4 WHEN 0 THEN 'FREEPORT 1' WHEN 1 THEN 'READVILLE' WHEN 2 THEN 'WASHINGTON ST' ELSE 'OTHER' END AS overnight_garage
 FROM events WHERE event_id % 3 = 0
""",
    "route": r"""
SELECT DISTINCT CAST(10000 + event_id % 120 AS STRING) AS rp_route, event_id % 120 % 40 AS route_set_id,
 concat('ROUTE ', CAST(event_id % 120 AS STRING)) AS route_name, CAST(event_id % 120 % 13 AS INT) AS actual_load, 'MTWHF' AS days FROM events
""",
    "route_set": r"""
SELECT DISTINCT event_id % 120 % 40 AS route_set_id, CASE event_id % 120 % 40 WHEN 0 THEN 'CHARLESTOWN HS Combo AM' WHEN 37 THEN 'Strive East Shuttle AM'
 WHEN 38 THEN 'SHUTTLE ALL DAY' WHEN 39 THEN 'Boston Ballet PM' ELSE concat('SET  ', CAST(event_id % 120 % 40 AS STRING), CASE WHEN event_id % 2 = 0 THEN ' am' ELSE ' PM' END) END AS route_set_name FROM events
""",
    "zone_visit": r"""
SELECT event_id AS visit_id, concat('B', CAST(user_id AS STRING)) AS asset,
 concat(CASE WHEN event_id % 2 = 0 THEN 'SCHOOL NATION_' ELSE 'ANNEX NATION_' END, CAST(event_id % 25 AS STRING)) AS zone,
 event_type AS category, ts + (event_id % 37 - 12) * INTERVAL '1' MINUTE AS time_in, value AS duration_s FROM events WHERE event_id % 4 <> 1
""",
    "vehicle_override": r"""
SELECT DISTINCT CAST(ts AS DATE) AS effective_date, CAST(10000 + event_id % 120 AS STRING) AS rp_route,
 concat('B', CAST(user_id AS STRING)) AS rp_vehicle, concat('S', CAST(user_id AS STRING)) AS original_rp_vehicle FROM events WHERE event_id % 21 = 0
""",
    "uncovered": r"""
SELECT DISTINCT CAST(e.ts AS DATE) AS date, CASE WHEN e.event_id % 66 = 0 THEN 'AM' WHEN e.event_id % 2 = 0 THEN 'am' ELSE 'PM' END AS ampm,
 CASE WHEN e.event_id % 66 = 0 THEN replace(s.route_set_name, '  ', ' ') WHEN e.event_id % 99 = 0 THEN concat(chr(160), s.route_set_name) ELSE concat(' ', s.route_set_name) END AS route_set, concat('B', CAST(e.user_id AS STRING)) AS bus
 FROM events e JOIN route_set s ON s.route_set_id = e.event_id % 120 % 40 WHERE e.event_id % 33 = 0
""",
    "location_schedule": r"""
SELECT effective_date, rp_route, rp_vehicle, anchor_abbrev, expected_time + INTERVAL '5' MINUTE AS planned_time, actual_time FROM trip
 WHERE direction = 'O' AND CAST(rp_route AS INT) % 7 <> 0
""",
    "zone": r"""
SELECT n_nationkey AS id, concat(CASE WHEN n_nationkey % 2 = 0 THEN 'SCHOOL NATION_' ELSE 'ANNEX NATION_' END, CAST(n_nationkey AS STRING)) AS name,
 CASE n_nationkey % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'view' WHEN 2 THEN 'error' WHEN 3 THEN 'purchase' ELSE 'signup' END AS category,
 CASE WHEN n_nationkey % 5 = 2 THEN 'other' ELSE 'school' END AS type FROM nation
""",
    "history": r"""
SELECT DISTINCT effective_date AS otp_date, CAST(NULL AS DOUBLE) AS otp_am, CAST(NULL AS DOUBLE) AS otp_pm FROM trip
UNION ALL SELECT DATE '1990-01-01', 0.5, 0.25
""",
    "route_pend": r"""
SELECT o_orderkey AS record_id, concat(CAST(o_orderkey AS STRING), CASE WHEN o_orderkey % 50 = 3 THEN 'D' ELSE '' END) AS visible_route_id, o_custkey AS vehicle_id, o_orderkey % 40 AS route_set_id,
 concat('NAME ', CAST(o_orderkey % 50 AS STRING)) AS name, CAST(o_orderkey % 60 AS INT) AS desired_load,
 CAST(o_orderkey % 60 + 0 * (o_orderkey % 15 - 7) AS INT) AS actual_load, CAST(1800 + 0 * (o_orderkey % 600 - 300) AS INT) AS route_time_s,
 CAST(floor(o_totalprice) + 0 * (o_orderkey % 400 - 200) AS INT) AS route_distance, CAST(25200 + 0 * (o_orderkey % 3) * 60 AS INT) AS anchor_time_s,
 o_orderpriority AS days, CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE 'N' END AS anchor_time_at_origin,
 o_orderkey % 2000 AS origin_point_id, (o_orderkey + 0 * (o_orderkey % 2)) % 2000 AS destination_point_id FROM orders WHERE o_orderkey % 20 <> 1
""",
    "route_plan": r"""
SELECT o_orderkey AS record_id, concat(CAST(o_orderkey AS STRING), CASE WHEN o_orderkey % 50 = 3 THEN 'D' ELSE '' END) AS visible_route_id,
 CASE WHEN o_orderkey % 4 = 3 THEN o_custkey % 100 + 1 ELSE o_custkey END AS vehicle_id,
 (o_orderkey + CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END) % 40 AS route_set_id,
 concat('NAME ', CAST(o_orderkey % 51 AS STRING)) AS name, CAST(o_orderkey % 60 + (o_orderkey % 5 - 2) AS INT) AS desired_load,
 CAST(o_orderkey % 60 + 1 * (o_orderkey % 15 - 7) AS INT) AS actual_load, CAST(1800 + CASE WHEN o_orderkey % 4 = 1 THEN 0 ELSE o_orderkey % 600 - 300 END AS INT) AS route_time_s,
 CAST(floor(o_totalprice) + CASE WHEN o_orderkey % 4 = 2 THEN 0 ELSE o_orderkey % 400 - 200 END AS INT) AS route_distance, CAST(25200 + (o_orderkey % 3 - 1) * 60 AS INT) AS anchor_time_s,
 CASE WHEN o_orderkey % 6 = 0 THEN 'MTW' ELSE o_orderpriority END AS days,
 CASE WHEN (o_orderkey + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END) % 2 = 0 THEN 'Y' ELSE 'N' END AS anchor_time_at_origin,
 o_orderkey % 2000 AS origin_point_id, (o_orderkey + 1 * (o_orderkey % 2)) % 2000 AS destination_point_id FROM orders WHERE o_orderkey % 20 <> 0
""",
    "route_detail_pend": r"""
SELECT DISTINCT l_orderkey * 10 + l_linenumber AS record_id, l_orderkey AS route_id FROM lineitem WHERE l_orderkey % 20 <> 1
""",
    "route_detail_plan": r"""
SELECT DISTINCT l_orderkey * 10 + l_linenumber AS record_id, l_orderkey AS route_id FROM lineitem WHERE l_orderkey % 20 <> 0
""",
    "request_pend": r"""
SELECT l_orderkey * 10 + l_linenumber AS record_id, CASE WHEN l_orderkey % 2 = 0 THEN 'O' ELSE 'I' END AS request_type,
 min(l_partkey) AS origin_point_id, max(l_partkey) AS destination_point_id FROM lineitem WHERE l_linenumber <> 6 AND l_orderkey % 20 <> 1 GROUP BY l_orderkey, l_linenumber
""",
    "request_plan": r"""
SELECT l_orderkey * 10 + l_linenumber AS record_id, CASE WHEN l_orderkey % 2 = 0 THEN 'O' ELSE 'I' END AS request_type,
 min(l_partkey) AS origin_point_id, max(l_partkey) AS destination_point_id FROM lineitem WHERE l_linenumber <> 7 AND l_orderkey % 20 <> 0 GROUP BY l_orderkey, l_linenumber
""",
    "satisfaction_pend": r"""
SELECT DISTINCT l_orderkey * 10 + l_linenumber AS trex_id, l_orderkey * 10 + l_linenumber AS pickup_route_detail_id FROM lineitem WHERE l_linenumber <> 6 AND l_orderkey % 20 <> 1
""",
    "satisfaction_plan": r"""
SELECT DISTINCT l_orderkey * 10 + l_linenumber AS trex_id, l_orderkey * 10 + l_linenumber AS pickup_route_detail_id FROM lineitem WHERE l_linenumber <> 7 AND l_orderkey % 20 <> 0
""",
    "point": r"""
SELECT p_partkey AS record_id, p_name AS description, CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN concat('STOP ', CAST(p_partkey AS STRING)) END AS custom_description FROM part
""",
    "vehicle": r"""
SELECT c_custkey AS record_id, concat('V', CAST(c_custkey AS STRING)) AS vehicle, CASE c_nationkey % 3 WHEN 0 THEN 'FREEPORT' WHEN 1 THEN 'READVILLE' ELSE 'WASHINGTON' END AS overnight_garage FROM customer
""",
    "point_pend": "SELECT record_id, description, custom_description FROM point",
    "point_plan": r"""
SELECT record_id, CASE WHEN record_id % 7 = 0 THEN concat(description, ' moved') ELSE description END AS description,
 CASE WHEN record_id % 5 = 0 THEN concat('NEW STOP ', CAST(record_id AS STRING)) ELSE custom_description END AS custom_description FROM point WHERE record_id % 97 <> 0
""",
    "vehicle_pend": "SELECT record_id, vehicle, overnight_garage FROM vehicle",
    "vehicle_plan": r"""
SELECT record_id, CASE WHEN record_id % 11 = 0 THEN concat('W', CAST(record_id AS STRING)) ELSE vehicle END AS vehicle,
 CASE WHEN record_id % 13 = 0 THEN 'OTHER YARD' ELSE overnight_garage END AS overnight_garage FROM vehicle WHERE record_id % 101 <> 0
""",
    "route_set_pend": "SELECT route_set_id, route_set_name FROM route_set",
    "route_set_plan": r"""
SELECT route_set_id, CASE WHEN route_set_id % 8 = 5 THEN concat(route_set_name, ' (new)') ELSE route_set_name END AS route_set_name FROM route_set WHERE route_set_id <> 17
""",
    "monitor": r"""
SELECT c_custkey AS record_id, c_mktsegment AS program_description, d.day, s.shift,
 CASE WHEN c_custkey % 7 <> 0 THEN concat('R', CAST(c_custkey % 100 AS STRING), s.shift) END AS route, concat('B', CAST(c_custkey % 50 AS STRING)) AS bus
 FROM customer CROSS JOIN (VALUES ('M'),('T'),('W'),('H'),('F')) d(day) CROSS JOIN (VALUES ('Pickup'),('Dropoff')) s(shift)
""",
}


def _names_used(sql: str, names) -> list[str]:
    return [name for name in names if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql)]


def with_list(sql: str, tables: dict[str, str]) -> str:
    """The entries of ``tables`` that ``sql`` is built on, as a WITH-list (without the word WITH) in their order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _names_used(text, tables):
            visit(tables[name])
            if name not in needed:
                needed.append(name)

    visit(sql)
    return ",\n".join(f"{name} AS ({tables[name].strip()})" for name in needed)


@lru_cache(maxsize=256)
def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The derived table ``name`` over the parquet files below ``sf_dir``."""
    body = with_list(f"FROM {name}", DERIVED_SQL)
    base = [f"{t} AS (SELECT * FROM parquet.`{sf_dir}/{t}.parquet`)" for t in _names_used(body, BASE_TABLES)]
    return spark.sql("WITH " + ",\n".join([*base, body]) + f"\nSELECT * FROM {name}")
