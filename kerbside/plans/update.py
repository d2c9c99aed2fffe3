"""From report rows to the updated report history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.operators.history import merge_history
from kerbside.plans.daily_rates import otp_summary, own_names
from kerbside.session import staged
from kerbside.sources.published import newest_version, publish, read_published


def update_history(
    history: DataFrame, report: DataFrame, allow_unmatched: bool = False, staging: str | None = None
) -> DataFrame:
    """Summarise a report and overwrite its dates in the history, whose key ``otp_date`` is a date or its US text.

    The history may carry its published headings (see ``flat_headings`` for those in two levels); the result has the same.
    The summary has one row per date. A date that the history does not hold exactly once fails the job that computes the
    result; the check is part of the plan, so the report runs once. ``staging``, a shared folder, has the summary written
    there first, so that a job that fails later need not repeat it.
    """
    headings = history.columns
    history = own_names(history)
    summary = staged(otp_summary(report), staging)
    if dict(history.dtypes)["otp_date"] == "date":
        summary = summary.withColumn("otp_date", F.to_date("otp_date", "MM/dd/yyyy"))
    return merge_history(history, summary, "otp_date", allow_unmatched, validate="plan").toDF(*headings)


def publish_update(folder: str, report: DataFrame, allow_unmatched: bool = False, staging: str | None = None) -> str:
    """Update the history that is published in ``folder`` and publish the result; returns the name of its version.

    If the report, a check or the write fails, the version before stays the one that is read.
    """
    spark = report.sparkSession
    held = newest_version(spark, folder)
    if held is None:
        raise ValueError(f"no history is published in {folder}")
    updated = update_history(read_published(spark, folder, held), report, allow_unmatched, staging)
    return publish(updated, folder, after=held)
