"""Input tables: the columns each one must bring, under the names of its source system and of this library."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableSpec:
    """Source column names (fixed values of the source systems) mapped to names and types used here.

    A column without a type keeps the one of its source.
    """

    name: str
    columns: tuple[tuple[str, str, str | None], ...]

    @property
    def required(self) -> list[str]:
        return [ours for _, ours, _ in self.columns]

    @property
    def ddl(self) -> str:
        """Declared schema of a headed text file that carries the source names."""
        return ", ".join(f"`{src}` {t or 'double'}" for src, _, t in self.columns)

    def select_from(self, df: DataFrame) -> DataFrame:
        """Keep the needed columns and give them their names and types; accepts either kind of name."""
        present = set(df.columns)
        missing = [src for src, ours, _ in self.columns if src not in present and ours not in present]
        if missing:
            raise ValueError(f"table {self.name} lacks the columns {missing}")
        found = [(F.col(f"`{ours if ours in present else src}`"), ours, t) for src, ours, t in self.columns]
        return df.select(*[(c.cast(t) if t else c).alias(ours) for c, ours, t in found])


def require_columns(df: DataFrame, columns: list[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")


BUILDING = TableSpec("building", (("Name", "name", "string"), ("AnchorAbbrev", "anchor_abbrev", "string")))
ROUTE = TableSpec(
    "route",
    (
        ("VisibleRouteID", "rp_route", "string"),
        ("RouteSetID", "route_set_id", "bigint"),
        ("Name", "route_name", "string"),
        ("ActualLoad", "actual_load", "int"),
        ("Days", "days", "string"),
    ),
)
ROUTE_SET = TableSpec(
    "route_set", (("RecordID", "route_set_id", "bigint"), ("Name", "route_set_name", "string"))
)
TRIP = TableSpec(
    "trip",
    (
        ("RPRoute", "rp_route", "string"),
        ("RPVehicle", "rp_vehicle", "string"),
        ("AnchorAbbrev", "anchor_abbrev", "string"),
        ("EffectiveDate", "effective_date", "date"),
        ("Direction", "direction", "string"),
        ("ExpectedTime", "expected_time", "timestamp_ntz"),
        ("ActualTime", "actual_time", "timestamp_ntz"),
        ("DelayTime", "delay_time", "int"),
        ("OvernightGarage", "overnight_garage", "string"),
    ),
)
LOCATION_SCHEDULE = TableSpec(
    "location_schedule",
    (
        ("EffectiveDate", "effective_date", "date"),
        ("RPRoute", "rp_route", "string"),
        ("RPVehicle", "rp_vehicle", "string"),
        ("AnchorAbbrev", "anchor_abbrev", "string"),
        ("PlannedTime", "planned_time", "timestamp_ntz"),
        ("ActualTime", "actual_time", "timestamp_ntz"),
    ),
)
VEHICLE_OVERRIDE = TableSpec(
    "vehicle_override",
    (
        ("EffectiveDate", "effective_date", "date"),
        ("RPRoute", "rp_route", "string"),
        ("RPVehicle", "rp_vehicle", "string"),
        ("OriginalRPVehicle", "original_rp_vehicle", "string"),
    ),
)
ZONE = TableSpec(
    "zone",
    (("id", "id", "int"), ("name", "name", "string"), ("category", "category", "string"), ("type", "type", "string")),
)
ZONE_VISIT = TableSpec(
    "zone_visit",
    (
        ("Asset", "asset", "string"),
        ("Zone", "zone", "string"),
        ("category", "category", "string"),
        ("time_in", "time_in", "timestamp_ntz"),
        ("duration", "duration_s", "double"),
    ),
)
UNCOVERED = TableSpec(
    "uncovered",
    (
        ("Date", "date", "date"),
        ("AM/PM", "ampm", "string"),
        ("Route Set", "route_set", "string"),
        ("Bus", "bus", "string"),
    ),
)
PLAN_ROUTE = TableSpec(
    "plan_route",
    (
        ("RecordID", "record_id", "bigint"),
        ("VisibleRouteID", "visible_route_id", "string"),
        ("VehicleID", "vehicle_id", "bigint"),
        ("RouteSetID", "route_set_id", "bigint"),
        ("Name", "name", "string"),
        ("DesiredLoad", "desired_load", "int"),
        ("ActualLoad", "actual_load", "int"),
        ("RouteTime", "route_time_s", "int"),
        ("RouteDistance", "route_distance", None),
        ("AnchorTime", "anchor_time_s", "int"),
        ("Days", "days", "string"),
        ("AnchorTimeAtOrigin", "anchor_time_at_origin", "string"),
        ("OriginPointID", "origin_point_id", "bigint"),
        ("DestinationPointID", "destination_point_id", "bigint"),
    ),
)
VEHICLE = TableSpec(
    "vehicle",
    (
        ("recordid", "record_id", "bigint"),
        ("vehicle", "vehicle", "string"),
        ("OvernightGarage", "overnight_garage", "string"),
    ),
)
ROUTE_DETAIL = TableSpec(
    "route_detail", (("RecordID", "record_id", "bigint"), ("RouteID", "route_id", "bigint"))
)
REQUEST = TableSpec(
    "request",
    (
        ("RecordID", "record_id", "bigint"),
        ("RequestType", "request_type", "string"),
        ("OriginPointID", "origin_point_id", "bigint"),
        ("DestinationPointID", "destination_point_id", "bigint"),
    ),
)
SATISFACTION = TableSpec(
    "satisfaction",
    (("TRexID", "trex_id", "bigint"), ("PickupRouteDetailID", "pickup_route_detail_id", "bigint")),
)
POINT = TableSpec(
    "point",
    (
        ("RecordID", "record_id", "bigint"),
        ("Description", "description", "string"),
        ("CustomDescription", "custom_description", "string"),
    ),
)
MONITOR = TableSpec(
    "monitor",
    (
        ("RecordID", "record_id", "bigint"),
        ("Program Description", "program_description", "string"),
        ("Day", "day", "string"),
        ("Shift", "shift", "string"),
        ("Route", "route", "string"),
        ("Bus", "bus", "string"),
    ),
)
SPECS = {
    s.name: s
    for s in (
        BUILDING, ROUTE, ROUTE_SET, TRIP, LOCATION_SCHEDULE, VEHICLE_OVERRIDE, ZONE, ZONE_VISIT, UNCOVERED,
        PLAN_ROUTE, VEHICLE, ROUTE_DETAIL, REQUEST, SATISFACTION, POINT, MONITOR,
    )
}
