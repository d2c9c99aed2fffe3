"""Report history, headings and filling down."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kerbside.operators.history import fill_down, flat_headings, merge_history

D = [dt.date(2024, 3, d) for d in (1, 2, 3)]
HISTORY = "otp_date date, otp_am double, otp_pm double"


@pytest.fixture()
def history(spark):
    return spark.createDataFrame([(D[0], 0.1, 0.2), (D[1], 0.3, 0.4), (D[2], None, None)], HISTORY)


def test_rows_of_the_updates_are_replaced(spark, history):
    updates = spark.createDataFrame([(D[1], 0.9, None, 7)], HISTORY + ", more int")
    merged = merge_history(history, updates).orderBy("otp_date").collect()
    assert [tuple(r) for r in merged] == [(D[0], 0.1, 0.2), (D[1], 0.9, None), (D[2], None, None)]


def test_missing_columns(spark, history):
    updates = spark.createDataFrame([(D[0], 0.5)], "otp_date date, otp_am double")
    with pytest.raises(ValueError):
        merge_history(history, updates)
    with pytest.warns(UserWarning):
        merged = merge_history(history, updates, allow_unmatched=True)
    assert tuple(merged.filter(F.col("otp_date") == D[0]).first()) == (D[0], 0.5, None)


def test_keys_must_name_one_row(spark, history):
    unknown = spark.createDataFrame([(dt.date(2025, 1, 1), 0.5, 0.5)], HISTORY)
    twice = spark.createDataFrame([(D[0], 0.5, 0.5), (D[0], 0.6, 0.6)], HISTORY)
    for updates in (unknown, twice):
        with pytest.raises(ValueError):
            merge_history(history, updates)
    doubled = history.unionByName(history)
    with pytest.raises(ValueError):
        merge_history(doubled, spark.createDataFrame([(D[0], 0.5, 0.5)], HISTORY))


def test_headings():
    groups = [None, "AM by Yard", None, "PM", None]
    names = ["OTP Date", "READ", "WASH", "Within Anchor", "7.30"]
    assert flat_headings(groups, names) == ["OTP.Date", "AM.by.Yard_READ", "AM.by.Yard_WASH", "PM_Within.Anchor", "PM_7.30"]
    assert flat_headings([None], ["15 min"]) == ["X15.min"]


def test_fill_down_in_chunks_equals_one_window(spark):
    rng = random.Random(5)
    rows = [
        (rng.choice(["a", "b", None]), i // 7, i, rng.choice([None, None, f"v{i}"]), rng.choice([None, None, None, i]))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "key string, hour int, i int, text string, number int")
    whole = fill_down(df, ["text", "number"], ["key"], ["i"])
    chunked = fill_down(df, ["text", "number"], ["key"], ["i"], chunk=F.col("hour"))
    assert sorted(map(str, whole.collect())) == sorted(map(str, chunked.collect()))
    last = {}
    for key, _, i, text, number in rows:
        seen = last.setdefault(key, [None, None])
        last[key] = [text if text is not None else seen[0], number if number is not None else seen[1]]
        assert chunked is not None
    ends = {r.key: r for r in whole.groupBy("key").agg(F.max_by(F.struct("text", "number"), "i").alias("s")).collect()}
    assert {k: (r.s.text, r.s.number) for k, r in ends.items()} == {k: tuple(v) for k, v in last.items()}


def test_fill_down_needs_a_partition(spark):
    with pytest.raises(ValueError):
        fill_down(spark.range(3), ["id"], [], ["id"])


def test_history_with_published_headings(spark, history):
    headed = history.toDF("OTP_Date", "AM.by.Time.Tier_7.30", "OTP_PM")
    updates = spark.createDataFrame([(D[1], 0.9, 0.8)], HISTORY).toDF(*headed.columns)
    merged = merge_history(headed, updates, key="OTP_Date")
    assert merged.columns == headed.columns
    assert sorted(map(tuple, merged.collect())) == [(D[0], 0.1, 0.2), (D[1], 0.9, 0.8), (D[2], None, None)]


def test_filling_in_chunks_shuffles_the_rows_once(spark, tmp_path):
    spark.range(1000).selectExpr(
        "nullif(id % 7, 3) AS key", "id div 100 AS hour", "id AS i", "nullif(id % 5, 2) AS v"
    ).write.parquet(f"{tmp_path}/rows")
    filled = fill_down(spark.read.parquet(f"{tmp_path}/rows"), ["v"], ["key"], ["i"], chunk=F.col("hour"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = filled._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 4  # the rows; their ends by chunk, by key and for the join
