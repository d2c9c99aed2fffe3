"""Session settings and staging."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: str = "*", app_name: str = "kerbside", **settings: str) -> SparkSession:
    """A session for one machine, as used by tests and the benchmark. On a cluster bring your own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str | None:
    """The shared folder that the session names, for callers that want to stage there."""
    return spark.conf.get("spark.checkpoint.dir", None) or None


#: Has Spark (4.1 or later) remove the shuffle files of an execution when it ends, not when the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stage(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written as Parquet below ``folder`` and read from there; lost executors then cost no recomputation.

    The shuffle files that it took are removed once it is written, so a plan that is staged in parts needs the disk of its
    largest part. All executors must share the folder. Whoever names it removes what is left there once results are read.
    """
    path = f"{folder.rstrip('/')}/stage-{uuid4().hex}"
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, folder: str | None) -> DataFrame:
    return stage(df, folder) if folder else df
