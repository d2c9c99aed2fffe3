"""Tables that are replaced as a whole while others read them.

A folder holds versions. A version is written aside and counts from the moment its job commits, which Spark marks by one
small file that it writes last; readers take the newest version that has the mark. So a table changes in one step, and a
write that fails, or an executor that is lost on the way, leaves the version before in place.
"""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_VERSION = re.compile(r"version-(\d{12})-[0-9a-f]{32}")
#: Written by Spark's committer when a job has ended well.
_MARK = "_SUCCESS"


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Names of the complete versions, oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/version-*/{_MARK}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(name for f in found if _VERSION.fullmatch(name := f.getPath().getParent().getName()))


def newest_version(spark: SparkSession, folder: str) -> str | None:
    return (versions(spark, folder) or [None])[-1]


def read_published(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    """The newest complete version, or the one named. A plan keeps reading the version that it began with."""
    version = version or newest_version(spark, folder)
    if version is None:
        raise ValueError(f"nothing is published in {folder}")
    return spark.read.parquet(f"{folder.rstrip('/')}/{version}")


def publish(df: DataFrame, folder: str, after: str | None = None) -> str:
    """Write ``df`` as the next version and return its name. It may be computed from an older version of the folder.

    ``after`` names the version that the caller built on; if another one has been published since, nothing is written.
    Two callers that pass this check at the same moment both publish, and the later name counts.
    """
    spark = df.sparkSession
    held = newest_version(spark, folder)
    if after is not None and held != after:
        raise RuntimeError(f"{folder} was published again: {held} after {after}")
    number = int(_VERSION.fullmatch(held)[1]) + 1 if held else 1
    version = f"version-{number:012d}-{uuid4().hex}"
    df.write.mode("errorifexists").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(
        f"{folder.rstrip('/')}/{version}"
    )
    return version
