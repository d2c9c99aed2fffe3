"""Report rows in the published flat layout, and the on-time rates of a day computed from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import rules
from kerbside.functions.text import route_number, text_or_na
from kerbside.functions.times import clock, minutes_of_day, us_date
from kerbside.schemas import require_columns

# Published heading of each column of the flat layout, in its order. The last two are left out of the
# old layout.
FLAT_HEADINGS = {
    "date": "Date",
    "route_date": "concatRouteDate",
    "route": "Route",
    "vehicle": "Vehicle",
    "anchor_location": "Anchor.Location",
    "planned_start_time": "Planned.Start.Time",
    "planned_anchor_time": "Planned.Anchor.Time",
    "actual_arrival_time": "Actual.Arrival.Time",
    "delay_minutes": "Delay.Minutes.",
    "on_time_by_anchor": "OnTimeRateByAnchor",
    "within_5_min": "Within5MinOfAnchor",
    "within_10_min": "Within10MinOfAnchor",
    "true_on_time": "TrueOnTime",
    "late_10_min": "Late10Min",
    "late_15_min": "Late15Min",
    "late_25_min": "Late25Min",
    "late_30_min": "Late30Min",
    "ampm": "AMPM",
    "time_tier": "TimeTier",
    "type_of_bus": "TypeOfBus",
    "bus_day": "BusDay",
    "yard": "Yard",
    "x_1": "X.1",
    "x_2": "X.2",
    "anchor_time_converted": "AnchorTimeConverted",
    "x_5": "X.5",
    "uncovered": "Uncovered",
    "excluded": "excludedShuttlesEtc",
}
OLD_LAYOUT_DROPS = ("uncovered", "excluded")

# Published heading of each daily rate.
RATE_HEADINGS = {
    "otp_date": "OTP_Date",
    "otp_am": "OTP_AM",
    "otp_pm": "OTP_PM",
    "am_tier_730": "AM.by.Time.Tier_7.30",
    "am_tier_830": "AM.by.Time.Tier_8.30",
    "am_tier_930": "AM.by.Time.Tier_9.30",
    "am_yard_read": "AM.by.Yard_READ",
    "am_yard_wash": "AM.by.Yard_WASH",
    "am_yard_frpt": "AM.by.Yard_FRPT",
    "am_within_anchor": "AM.OTP_Within.Anchor",
    "am_within_15_of_on_time": "AM.OTP_Within.15.Minutes.of.On.Time",
    "am_within_30_of_school_time": "AM.OTP_Within.30.Minutes.of.School.Time",
    "pm_yard_read": "PM.by.Yard_READ",
    "pm_yard_wash": "PM.by.Yard_WASH",
    "pm_yard_frpt": "PM.by.Yard_FRPT",
    "pm_within_anchor": "PM.OTP_Within.Anchor",
    "pm_within_15_of_on_time": "PM.OTP_Within.15.Minutes.of.On.Time",
    "pm_within_30_of_school_time": "PM.OTP_Within.30.Minutes.of.School.Time",
}


def lateness_flags(uncovered: Column, delay: Column) -> dict[str, Column]:
    return {name: rules.on_time_flag(uncovered, delay, limit) for name, limit in rules.LATENESS_LIMITS.items()}


def prepare_raw(report: DataFrame, oldstyle: bool = False) -> DataFrame:
    """Report rows in the flat layout; rows that already have it are returned as they are."""
    if set(FLAT_HEADINGS) - set(OLD_LAYOUT_DROPS) <= set(report.columns):
        return report
    require_columns(
        report, ["rp_route", "rp_vehicle", "date", "expected_time", "arrival", "delay_combined"], "on-time report"
    )
    date = us_date(F.col("date"))
    minutes = minutes_of_day(F.col("expected_time"), F.col("date"))
    columns = {
        "date": date,
        "route_date": F.concat(text_or_na(F.col("rp_route")), F.lit(": "), text_or_na(date)),
        "route": route_number(F.col("rp_route")),
        "vehicle": F.col("rp_vehicle"),
        "anchor_location": F.col("anchor_abbrev"),
        "planned_start_time": F.lit(""),
        "planned_anchor_time": clock(F.col("expected_time")),
        "actual_arrival_time": clock(F.col("arrival")),
        "delay_minutes": F.col("delay_combined"),
        **lateness_flags(F.col("uncovered"), F.col("delay_combined")),
        "ampm": F.col("ampm"),
        "time_tier": rules.time_tier(minutes),
        "type_of_bus": F.substring("rp_vehicle", 1, 1),
        "bus_day": F.concat(text_or_na(F.col("rp_vehicle")), F.lit(": "), text_or_na(date)),
        "yard": rules.yard_code(F.col("overnight_garage")),
        "x_1": F.lit(""),
        "x_2": F.lit(""),
        "anchor_time_converted": minutes,
        "x_5": F.lit(""),
        "uncovered": F.col("uncovered"),
        "excluded": F.col("excluded"),
    }
    kept = [name for name in FLAT_HEADINGS if not (oldstyle and name in OLD_LAYOUT_DROPS)]
    return report.select(*[columns[name].alias(name) for name in kept])


def _measures() -> dict[str, tuple[Column, str]]:
    """Each daily rate: the rows it is taken over and the flag it averages."""
    am, pm = F.col("ampm") == "AM", F.col("ampm") == "PM"
    tier, yard = F.col("time_tier"), F.col("yard")
    return {
        "otp_am": (am, "true_on_time"),
        "otp_pm": (pm, "within_10_min"),
        # The tiers are not restricted to the morning, in spite of their names.
        "am_tier_730": (tier == "7:30", "true_on_time"),
        "am_tier_830": (tier == "8:30", "true_on_time"),
        "am_tier_930": (tier == "9:30", "true_on_time"),
        "am_yard_read": (am & (yard == "Read"), "true_on_time"),
        "am_yard_wash": (am & (yard == "Wash"), "true_on_time"),
        "am_yard_frpt": (am & (yard == "Frpt"), "true_on_time"),
        "am_within_anchor": (am, "on_time_by_anchor"),
        "am_within_15_of_on_time": (am, "late_15_min"),
        "am_within_30_of_school_time": (am, "late_30_min"),
        "pm_yard_read": (pm & (yard == "Read"), "within_10_min"),
        "pm_yard_wash": (pm & (yard == "Wash"), "within_10_min"),
        "pm_yard_frpt": (pm & (yard == "Frpt"), "within_10_min"),
        "pm_within_anchor": (pm, "on_time_by_anchor"),
        "pm_within_15_of_on_time": (pm, "late_10_min"),
        "pm_within_30_of_school_time": (pm, "late_25_min"),
    }


def otp_summary(report_or_raw: DataFrame) -> DataFrame:
    """The 17 on-time rates of every date, over rows that are not excluded. One combining aggregate."""
    raw = prepare_raw(report_or_raw)
    require_columns(raw, ["excluded"], "flat layout")
    counted = ~F.col("excluded")
    rates = [F.avg(F.when(counted & rows, F.col(flag))).alias(name) for name, (rows, flag) in _measures().items()]
    return raw.groupBy(F.col("date").alias("otp_date")).agg(*rates)


def published_names(df: DataFrame) -> DataFrame:
    """A flat layout or a summary under its published headings (those with dots need back-ticks in Spark)."""
    headings = RATE_HEADINGS if "otp_date" in df.columns else FLAT_HEADINGS
    return df.select(*[F.col(c).alias(h) for c, h in headings.items() if c in df.columns])


def own_names(df: DataFrame) -> DataFrame:
    """Columns under published headings get the names used here; others keep theirs. The inverse of ``published_names``."""
    ours = {h: c for c, h in {**FLAT_HEADINGS, **RATE_HEADINGS}.items()}
    return df.toDF(*[ours.get(c, c) for c in df.columns])
