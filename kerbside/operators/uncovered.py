"""The list of uncovered trips: cleaning, attaching it to trips and taking out those that ran after all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.text import squish
from kerbside.operators.joins import join_on, with_membership
from kerbside.schemas import UNCOVERED


def normalise_uncovered(uncovered: DataFrame) -> DataFrame:
    """List rows with cleaned texts, capital half-day and the constant flag."""
    return UNCOVERED.select_from(uncovered).select(
        "date",
        squish(F.upper("ampm")).alias("ampm"),
        squish(F.col("route_set")).alias("route_set_name"),
        squish(F.col("bus")).alias("rp_vehicle"),
        F.lit(True).alias("uncovered"),
    )


def attach_uncovered(trips: DataFrame, uncovered: DataFrame) -> DataFrame:
    """Trips with the flag ``uncovered``, never null. A trip that is listed twice comes out twice."""
    keys = [("original_rp_vehicle", "rp_vehicle"), "ampm", "route_set_name", ("effective_date", "date")]
    joined = join_on(trips, normalise_uncovered(uncovered), null_safe=keys)
    return joined.withColumn("uncovered", F.coalesce("uncovered", F.lit(False)))


def flag_removable(uncovered: DataFrame, covered: DataFrame, match: str = "all") -> DataFrame:
    """The list as it is with the flag ``removed``: does a covered trip answer to this row.

    ``match="all"`` compares the four keys together on cleaned values, by the original vehicle. ``match="any"`` asks for
    each raw key alone whether it occurs among the covered trips, by the vehicle that drove.
    """
    if match == "all":
        keys = ["date", "ampm", "route_set", "bus"]
        trips = covered.select(
            "date",
            "ampm",
            F.col("route_set_name").alias("route_set"),
            F.col("original_rp_vehicle").alias("bus"),
        ).distinct()
        cleaned = {
            "__date": F.col("date"),
            "__ampm": squish(F.upper("ampm")),
            "__route_set": squish(F.col("route_set")),
            "__bus": squish(F.col("bus")),
        }
        joined = join_on(
            uncovered.withColumns(cleaned),
            trips.withColumn("__hit", F.lit(True)),
            null_safe=[(f"__{k}", k) for k in keys],
        )
        return joined.withColumn("removed", F.col("__hit").isNotNull()).drop("__hit", *cleaned)
    if match == "any":
        members = {"date": "date", "ampm": "ampm", "route_set": "route_set_name", "bus": "rp_vehicle"}
        flagged = uncovered
        for key, column in members.items():
            flagged = with_membership(flagged, key, covered, column, f"__in_{key}")
        flags = [f"__in_{key}" for key in members]
        removed = F.col(flags[0]) & F.col(flags[1]) & F.col(flags[2]) & F.col(flags[3])
        return flagged.withColumn("removed", removed).drop(*flags)
    raise ValueError('match must be "all" or "any"')


def reconcile_uncovered(uncovered: DataFrame, covered: DataFrame, match: str = "all") -> tuple[DataFrame, DataFrame]:
    """The rows to keep and the rows to remove, which together are the list."""
    flagged = flag_removable(uncovered, covered, match)
    return flagged.filter(~F.col("removed")).drop("removed"), flagged.filter("removed").drop("removed")
