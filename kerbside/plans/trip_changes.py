"""Differences between a pending and a new route plan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.rules import direction_code
from kerbside.functions.text import clock_text, number_text, numeric, route_number
from kerbside.operators.joins import join_on, with_membership
from kerbside.operators.stops import Snapshot, both_sides, enrich_routes, point_texts, stop_changes
from kerbside.schemas import PLAN_ROUTE, VEHICLE
from kerbside.session import staged

# The compared attributes in the order of the report, with their published names.
VARIABLES = {
    "route": "Route",
    "direction": "Direction",
    "route_name": "RouteName",
    "route_set": "RouteSet",
    "days": "Days",
    "anchor_location": "AnchorLocation",
    "anchor_time": "AnchorTime",
    "vehicle": "Vehicle",
    "yard": "Yard",
    "stops": "Stops",
    "desired_load": "DesiredLoad",
    "actual_load": "ActualLoad",
    "route_distance": "RouteDistance",
    "route_time": "RouteTime",
}

# Differences from which the old rule reports a change.
OLD_LOAD_STEP = 5
OLD_MINUTES_STEP = 3


@dataclass(frozen=True)
class Thresholds:
    """A change in load, minutes or distance is shown if it is larger than this."""

    load: float = 5
    minutes: float = 3
    distance: float = 100


@dataclass(frozen=True)
class Fixes:
    """Corrections of known slips, off by default so that results stay comparable.

    ``anchor``: inbound routes get their destination as anchor. ``direction``: the new direction comes from the new
    plan. ``any_change``: ``signed`` adds signed differences, so that decreases can cancel changes, ``abs`` does not.
    ``old_rule_key``: key of the old rule, ``record_id`` or ``visible_route_id``.
    """

    anchor: bool = False
    direction: bool = False
    any_change: str = "signed"
    old_rule_key: str = "record_id"


def _changed_by_old_rule(new: Callable[[str], Column], old: Callable[[str], Column]) -> Column:
    """Bus, load or whole minutes changed by the old, inclusive rule; never null.

    An old load that is missing counts as 0 and an old time as unchanged; a new bus must be known.
    """

    def differs(after: Column, before: Column, step: int) -> Column:
        return F.coalesce(F.abs(after - before) >= step, F.lit(False))

    def minutes(seconds: Column) -> Column:
        return (seconds / 60).cast("int")

    bus = F.coalesce(new("vehicle"), F.lit(""))
    changed = (
        (bus != F.coalesce(old("vehicle"), F.lit("")))
        | differs(new("actual_load"), F.coalesce(old("actual_load"), F.lit(0)), OLD_LOAD_STEP)
        | differs(minutes(new("route_time_s")), minutes(old("route_time_s")), OLD_MINUTES_STEP)
    )
    return changed & (bus != "")


_OLD_RULE_VALUES = ("vehicle", "actual_load", "route_time_s")


def old_change_rule(pending: DataFrame, plan: DataFrame, key: str = "record_id") -> DataFrame:
    """Routes (enriched) of the new plan whose bus, load or whole minutes changed by the old rule.

    A missing key never matches.
    """
    old = pending.select(F.col(key), *[F.col(c).alias(f"old_{c}") for c in _OLD_RULE_VALUES])
    both = join_on(plan.select(key, *_OLD_RULE_VALUES), old, plain=[key])
    changed = _changed_by_old_rule(F.col, lambda name: F.col(f"old_{name}"))
    return both.filter(changed).select(F.col(key).alias("route"), F.col("vehicle").alias("bus"))


def _routes_by_old_rule(pending: Snapshot, plan: Snapshot, key: str) -> DataFrame:
    """The keys (``route``) that ``old_change_rule`` gives, found side by side.

    Routes of both snapshots meet their vehicles in one join and are dealt once, by key. A key collects its different
    values, which are one per snapshot unless it repeats; missing keys match nothing and are spread.
    """
    names = [key, "vehicle_id", "actual_load", "route_time_s"]
    routes = both_sides(*[PLAN_ROUTE.select_from(s.routes).select(*names) for s in (pending, plan)])
    vehicles = both_sides(*[VEHICLE.select_from(s.vehicles).select("record_id", "vehicle") for s in (pending, plan)])
    vehicles = vehicles.withColumnRenamed("record_id", "vehicle_record")
    known = join_on(routes, vehicles, null_safe=[("vehicle_id", "vehicle_record")], plain=["in_plan"])
    values = F.struct(*_OLD_RULE_VALUES)
    spread = F.when(F.col(key).isNull(), F.xxhash64("in_plan", *_OLD_RULE_VALUES))
    sides = known.groupBy(key, spread.alias("spread")).agg(
        F.collect_set(F.when(~F.col("in_plan"), values)).alias("old"),
        F.collect_set(F.when(F.col("in_plan"), values)).alias("new"),
    )
    absent = F.array(F.lit(None).cast(sides.schema["old"].dataType.elementType))
    # Copies and pairs count once: only whether any pair changed is asked.
    old = F.when((F.size("old") > 0) & F.col(key).isNotNull(), F.col("old")).otherwise(absent)
    changed = F.exists(
        "new", lambda n: F.exists(old, lambda o: _changed_by_old_rule(lambda c: n[c], lambda c: o[c]))
    )
    return sides.filter(changed).select(F.col(key).alias("route"))


def route_anchors(enriched: DataFrame, points: DataFrame, fix_anchor: bool = False) -> DataFrame:
    """Routes with anchor point and its text. Only routes timed at the origin get one unless ``fix_anchor`` is set."""
    at_origin = F.col("anchor_time_at_origin")
    anchor = F.when(at_origin == "Y", F.col("origin_point_id"))
    if fix_anchor:
        anchor = anchor.when(at_origin == "N", F.col("destination_point_id"))
    texts = point_texts(points).withColumnsRenamed({"stop_description": "anchor_location"})
    return join_on(
        enriched.withColumn("anchor_point_id", anchor), texts, null_safe=[("anchor_point_id", "record_id")]
    )


ID_KEY = ["id_key", "id_none"]


def _id_keys(column: str) -> list[Column]:
    """A visible route id as two never-null columns that are equal for equal ids and for missing ones."""
    return [F.coalesce(column, F.lit("")).alias("id_key"), F.col(column).isNull().alias("id_none")]


def _route_ids(pending: Snapshot, plan: Snapshot, fixes: Fixes) -> DataFrame:
    """Every visible route id of either snapshot once, by its key, with the flag ``in_old_rule``.

    The flag is found here, on narrow rows, so that the compared rows need not be dealt by the number of their route.
    """
    ids = [PLAN_ROUTE.select_from(s.routes).select("visible_route_id") for s in (pending, plan)]
    numbered = ids[0].unionByName(ids[1]).select(
        *_id_keys("visible_route_id"), route_number(F.col("visible_route_id")).cast("bigint").alias("number")
    )
    old_rule = _routes_by_old_rule(pending, plan, fixes.old_rule_key)
    members = old_rule.select(numeric(F.col("route")).try_cast("bigint").alias("route"))
    flagged = with_membership(numbered, "number", members, "route", "in_old_rule")
    return flagged.groupBy(*ID_KEY).agg(F.bool_or("in_old_rule").alias("in_old_rule"))


def _paired_routes(pending: Snapshot, plan: Snapshot, fixes: Fixes, staging: str | None) -> DataFrame:
    """Full join of the enriched routes of both snapshots, with every column marked by its side, their stop changes and
    the flag ``in_old_rule``.

    Everything is joined to the ids of both snapshots, which a full join's rows would be dealt by once more: the wide rows
    of a side are moved by id only once. What is joined is staged part by part, if a folder is given.
    """
    paired = staged(_route_ids(pending, plan, fixes), staging)
    changes = staged(stop_changes(pending, plan, staging), staging)
    changes = changes.select(*_id_keys("visible_route_id"), *changes.columns[1:])
    paired = join_on(paired, changes, plain=ID_KEY)
    for snapshot, side in ((pending, "pend"), (plan, "plan")):
        anchored = staged(route_anchors(enrich_routes(snapshot), snapshot.points, fixes.anchor), staging)
        marked = anchored.select(*_id_keys("visible_route_id"), *[F.col(c).alias(f"{c}_{side}") for c in anchored.columns])
        paired = join_on(paired, marked, plain=ID_KEY)
    return paired.withColumn("visible_route_id", F.when(~F.col("id_none"), F.col("id_key"))).drop(*ID_KEY)


class _Comparison:
    """Collects the columns of the 14 attributes, whether any changed, and whether any has a text to show.

    The two flags are used as filters. They are written over the source columns and never repeat the expression of an
    output column: Catalyst derives a constraint for every mix of an expression and its alias in a filter, and that
    number doubles with each attribute.
    """

    def __init__(self, text_of, any_change: str):
        self.columns: dict[str, Column] = {}
        self.noted: list[Column] = []
        self._amounts: list[Column] = []
        self._text_of = text_of
        self._any_change = any_change

    def put(self, name: str, diff: Column, amount: Column, shown: Column, added: Column, removed: Column) -> None:
        self.columns[f"{name}_diff"] = diff
        self.columns[f"{name}_added"] = F.when(shown, added).otherwise("")
        self.columns[f"{name}_removed"] = F.when(shown, removed).otherwise("")
        self._amounts.append(F.abs(amount) if self._any_change == "abs" else amount)
        self.noted.append(shown & ((added != "") | (removed != "")))

    def put_unequal(self, name: str, before: Column, after: Column, old_text: Column, new_text: Column) -> None:
        unequal = after != before
        self.put(name, unequal.cast("int"), F.when(unequal, 1.0).otherwise(0.0), unequal, new_text, old_text)

    def put_number(self, name: str, column: str, shown_above: float | None, text=None) -> None:
        """A signed difference, shown if it grew or, with a limit, if it is larger either way."""
        new, old = F.col(f"{column}_plan"), F.col(f"{column}_pend")
        change = new.cast("double") - old.cast("double")
        shown = change > 0 if shown_above is None else F.abs(change) > shown_above
        texts = [(text or self._text_of)(f"{column}_{side}") for side in ("plan", "pend")]
        self.put(name, new - old, F.coalesce(change, F.lit(0.0)), shown, *texts)

    @property
    def any_change(self) -> Column:
        return reduce(add, self._amounts) > 0


def _compare_routes(
    pending: Snapshot, plan: Snapshot, thresholds: Thresholds, fixes: Fixes, staging: str | None
) -> DataFrame:
    """``route_diff`` with the extra flag ``noted``: is there a text to show."""
    routes = _paired_routes(pending, plan, fixes, staging)
    seen = _Comparison(lambda name: number_text(routes, name), fixes.any_change)

    def old(name: str) -> Column:
        return F.col(f"{name}_pend")

    def new(name: str) -> Column:
        return F.col(f"{name}_plan")

    only_new = new("record_id").isNotNull() & old("record_id").isNull()
    only_old = old("record_id").isNotNull() & new("record_id").isNull()
    one_sided = only_new | only_old
    id_text = [F.when(only, side("record_id").cast("string")).otherwise("") for only, side in ((only_new, new), (only_old, old))]
    seen.put("route", one_sided.cast("int"), F.when(one_sided, 1.0).otherwise(0.0), one_sided, *id_text)

    before = direction_code(old("anchor_time_at_origin"))
    if fixes.direction:
        after = direction_code(new("anchor_time_at_origin"))
        seen.put_unequal("direction", before, after, before, after)
    else:
        # Both directions come from the pending plan: known ones are equal, so no text is ever shown.
        seen.put("direction", F.when(before.isNotNull(), 0), F.lit(0.0), F.lit(False), before, before)
    for name, compared, shown in (
        ("route_name", "name", "name"),
        ("route_set", "route_set_id", "route_set"),
        ("days", "days", "days"),
        ("anchor_location", "anchor_point_id", "anchor_location"),
    ):
        seen.put_unequal(name, old(compared), new(compared), old(shown), new(shown))
    seen.put_number("anchor_time", "anchor_time_s", None, lambda name: clock_text(F.col(name)))
    for name in ("vehicle", "yard"):
        seen.put_unequal(name, old(name), new(name), old(name), new(name))
    n_stops = F.coalesce("n_stops_changed", F.lit(0))
    stop_texts = [F.coalesce(c, F.lit("")) for c in ("stops_added", "stops_removed")]
    seen.put("stops", n_stops, n_stops.cast("double"), F.col("n_stops_changed").isNotNull(), *stop_texts)
    seen.put_number("desired_load", "desired_load", None)
    seen.put_number("actual_load", "actual_load", thresholds.load)
    seen.put_number("route_distance", "route_distance", thresholds.distance)
    seen.put_number("route_time", "route_time_s", thresholds.minutes * 60)

    return routes.select(
        "visible_route_id",
        *[c.alias(n) for n, c in seen.columns.items()],
        seen.any_change.alias("any_change"),
        F.coalesce(reduce(or_, seen.noted), F.lit(False)).alias("noted"),
        "in_old_rule",
    )


def route_diff(
    pending: Snapshot,
    plan: Snapshot,
    thresholds: Thresholds = Thresholds(),
    fixes: Fixes = Fixes(),
    staging: str | None = None,
) -> DataFrame:
    """One row per route of either snapshot with difference, new and old text of 14 attributes.

    With ``staging``, a shared folder, the parts of the plan (what serves requests and the stops of a side, stop changes,
    routes of a side) are written there one after another; shuffle files of a part go once it is written (``stage``).
    """
    return _compare_routes(pending, plan, thresholds, fixes, staging).drop("noted")


def change_long(diffs: DataFrame) -> DataFrame:
    """Changed routes in long form: one row per route and attribute with its difference, new and old text."""
    cells: list[Column] = []
    for position, (name, published) in enumerate(VARIABLES.items()):
        diff = F.col(f"{name}_diff").cast("double")
        cells += [F.lit(position), F.lit(published), diff, F.col(f"{name}_added"), F.col(f"{name}_removed")]
    rows = F.stack(F.lit(len(VARIABLES)), *cells).alias("position", "variable", "diff", "added", "removed")
    return diffs.filter("any_change").select("visible_route_id", rows)


def _note(variable: str | Column, added: Column, removed: Column) -> Column:
    """``Variable old => new`` if either text is there, else null."""
    name = F.lit(variable) if isinstance(variable, str) else variable
    text = F.concat(name, F.lit(" "), F.coalesce(removed, F.lit("NA")), F.lit(" => "), F.coalesce(added, F.lit("NA")))
    return F.when((added != "") | (removed != ""), text)


def change_notes(long: DataFrame) -> DataFrame:
    """One text per route with all its notes in the order of the attributes; routes without a note are left out."""
    noted = long.withColumn("note", _note(F.col("variable"), F.col("added"), F.col("removed")))
    entries = F.array_sort(F.collect_list(F.struct("position", "note")))
    text = F.array_join(F.transform(entries, lambda e: e["note"]), ";\n")
    return noted.filter(F.col("note").isNotNull()).groupBy("visible_route_id").agg(text.alias("notes"))


def tripchange_report(
    pending: Snapshot,
    plan: Snapshot,
    thresholds: Thresholds = Thresholds(),
    fixes: Fixes = Fixes(),
    repeated_routes: bool = False,
    staging: str | None = None,
) -> DataFrame:
    """Changed routes with their differences and readable notes; changed routes without a note are left out.

    A snapshot holds a visible route id once, so the notes of a route are those of its row and need no further
    shuffle. Set ``repeated_routes`` if ids repeat: all rows of an id then share the notes of all of them. ``staging`` is
    that of ``route_diff``.
    """
    compared = _compare_routes(pending, plan, thresholds, fixes, staging).filter("any_change")
    changed = compared.drop("noted")
    if repeated_routes:
        return join_on(changed, change_notes(change_long(changed)), null_safe=["visible_route_id"], how="inner")
    notes = [_note(v, F.col(f"{n}_added"), F.col(f"{n}_removed")) for n, v in VARIABLES.items()]
    return compared.filter("noted").drop("noted").withColumn("notes", F.concat_ws(";\n", *notes))


def published_changes(report: DataFrame) -> DataFrame:
    """The report under its published headings (those with dots need back-ticks in Spark)."""
    headings = {"visible_route_id": "VisibleRouteID"}
    for name, published in VARIABLES.items():
        headings.update({f"{name}_{part}": f"{published}.{part}" for part in ("diff", "added", "removed")})
    headings.update({"any_change": "AnyChange", "in_old_rule": "InOldGreensheet", "notes": "Notes"})
    return report.select(*[F.col(c).alias(h) for c, h in headings.items()])
