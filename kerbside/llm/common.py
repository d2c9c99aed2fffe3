"""Helpers shared by the operators of this folder: staging, native column idioms, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, inside a regular expression's brackets.
SPACE = r"\x20\x09-\x0D"


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Where a local session names none, one of its own is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="kerbside-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def settle(df: DataFrame, what: str = "stage") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: lineage is cut, lost executors cost nothing."""
    spark = df.sparkSession
    path = new_folder(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where the body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, as an array; null counts as empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Smallest reachable id of every node of ``edges`` (a, b: any orderable type): columns id, label.

    Alternates large-star and small-star: every node keeps links to the smallest neighbour only, so that no row ever
    holds a neighbourhood and a hub is never gathered in one place (minima combine on the map side). It stops when the
    links no longer change; only counts reach the driver.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    links = settle(links, "links")
    before = None
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        links = settle(small, "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    roots = links.select("v").distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(
        roots.select(F.col("v").alias("id"), F.col("v").alias("label"))
    )
