"""Reading the input tables and writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.schemas import SPECS


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """The table ``name`` of ``kerbside.schemas`` from files, with its columns selected, typed and renamed.

    Text formats are read with the declared schema, never by inference. Column pruning reaches the scan.
    """
    reader = spark.read.options(**options)
    if fmt == "csv":
        headed = spark.read.options(header="true", enforceSchema="false", **options)
        return SPECS[name].select_from(headed.schema(SPECS[name].ddl).csv(path))
    if fmt == "json":
        return SPECS[name].select_from(reader.schema(SPECS[name].ddl).json(path))
    return SPECS[name].select_from(reader.format(fmt).load(path))


def read_jdbc(spark: SparkSession, name: str, url: str, dbtable: str, **options: str) -> DataFrame:
    """The table ``name`` from a database. Give ``partitionColumn``, bounds and ``numPartitions`` for large tables.

    Selected columns and filters on them are sent to the database.
    """
    settings = {"url": url, "dbtable": dbtable, "preferTimestampNTZ": "true", **options}
    return SPECS[name].select_from(spark.read.format("jdbc").options(**settings).load())


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Write a result to a new location; an existing one is an error, since a plan may still read from it."""
    writer = df.write.format(fmt).mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


VISIT_DATE = "visit_date"


def write_visits(visits: DataFrame, path: str) -> None:
    """Visits by the date of ``time_in``, in the partition column ``visit_date``; name it in ``visits_dated_by`` to use it.

    Rows of a date are brought together first, so that a date has a few files and not one of every task; a date of very
    many rows is split.
    """
    dated = visits.withColumn(VISIT_DATE, F.to_date(F.col("time_in").cast("timestamp_ntz")))
    write_table(dated.hint("rebalance", VISIT_DATE), path, [VISIT_DATE])
