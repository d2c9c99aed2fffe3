"""Building list: cleaning, the names of an anchor and the known anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.text import squish_strings
from kerbside.operators.joins import join_on, with_membership
from kerbside.schemas import BUILDING, ZONE


def anchored_buildings(buildings: DataFrame) -> DataFrame:
    """Buildings with a non-empty anchor, texts cleaned."""
    return squish_strings(BUILDING.select_from(buildings).filter(F.col("anchor_abbrev") != ""))


def building_names(anchored: DataFrame) -> DataFrame:
    """One row per anchor: its distinct names, sorted and joined by semicolons; empty text if all are missing.

    Copies of a name are dropped by a combining aggregate before any list is built.
    """
    distinct = anchored.select("anchor_abbrev", "name").distinct()
    names = F.array_join(F.array_sort(F.collect_list("name")), "; ")
    return distinct.groupBy("anchor_abbrev").agg(names.alias("names"))


def resolve_anchor(trips: DataFrame, anchored: DataFrame, column: str = "anchor_abbrev") -> DataFrame:
    """Replace an anchor that no building has by its first four characters."""
    checked = with_membership(trips, column, anchored, "anchor_abbrev", "__known")
    anchor = F.when(F.col("__known"), F.col(column)).otherwise(F.substring(column, 1, 4))
    return checked.withColumn(column, anchor).drop("__known")


def zone_anchors(zones: DataFrame, anchored: DataFrame) -> DataFrame:
    """Distinct anchors of the buildings that are also GPS zones."""
    named = squish_strings(ZONE.select_from(zones).select("name"))
    return join_on(named, anchored, null_safe=["name"], how="inner").select("anchor_abbrev").distinct()
