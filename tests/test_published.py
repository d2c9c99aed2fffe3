"""Publication in one step, and the checks inside the plan of a history update."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbside.operators.history import merge_history
from kerbside.plans import update
from kerbside.sources.published import newest_version, publish, read_published, versions

D = [dt.date(2024, 3, d) for d in (1, 2, 3)]
HISTORY = "otp_date date, otp_am double, otp_pm double"


@pytest.fixture()
def history(spark):
    return spark.createDataFrame([(D[0], 0.1, 0.2), (D[1], 0.3, 0.4), (None, 0.7, 0.8)], HISTORY)


def test_readers_see_the_newest_version(spark, history, tmp_path):
    folder = tmp_path.as_uri()
    assert newest_version(spark, folder) is None
    with pytest.raises(ValueError):
        read_published(spark, folder)
    first = publish(history, folder)
    held = read_published(spark, folder)
    second = publish(held.filter("otp_am < 0.2"), folder, after=first)
    assert versions(spark, folder) == [first, second]
    assert read_published(spark, folder).count() == 1
    # A plan that began with the first version still reads it.
    assert held.count() == 3 and read_published(spark, folder, first).count() == 3
    with pytest.raises(RuntimeError):
        publish(history, folder, after=first)


def test_a_failed_write_leaves_the_old_history(spark, history, tmp_path):
    folder = tmp_path.as_uri()
    first = publish(history, folder)
    broken = read_published(spark, folder).withColumn(
        "otp_am", F.when(F.col("otp_am") > 0.2, F.raise_error(F.lit("lost"))).otherwise(F.col("otp_am"))
    )
    with pytest.raises(Exception, match="lost"):
        publish(broken, folder)
    # Files of a writer that was lost before its job ended are not a version either.
    history.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{folder}/version-000000000009-{'0' * 32}"
    )
    assert versions(spark, folder) == [first]
    assert read_published(spark, folder).count() == 3
    assert publish(history.limit(1), folder) > first
    assert read_published(spark, folder).count() == 1


def merged(history, updates):
    return merge_history(history, updates, validate="plan")


def test_merge_with_checks_in_the_plan(spark, history):
    updates = spark.createDataFrame([(D[1], 0.9, None)], HISTORY)
    key = lambda r: str(r[0])
    expected = sorted([(D[0], 0.1, 0.2), (D[1], 0.9, None), (None, 0.7, 0.8)], key=key)
    assert sorted((tuple(r) for r in merged(history, updates).collect()), key=key) == expected
    same = merge_history(history, updates).collect()
    assert sorted(map(tuple, same), key=key) == expected
    # Rows of the history that repeat are an error only where the updates name them.
    doubled = history.unionByName(history)
    none = spark.createDataFrame([], HISTORY)
    assert merged(doubled, none).count() == 6
    with pytest.raises(ValueError):
        merge_history(history, updates, validate="later")


@pytest.mark.parametrize(
    "updates, message",
    [
        ([(dt.date(2025, 1, 1), 0.5, 0.5)], "2025-01-01 does not name exactly one row"),
        ([(D[0], 0.5, 0.5), (D[0], 0.6, 0.6)], "2024-03-01 occurs more than once"),
        ([(None, 0.5, 0.5)], "null does not name exactly one row"),
    ],
)
def test_bad_keys_fail_the_job(spark, history, updates, message):
    bad = merged(history, spark.createDataFrame(updates, HISTORY))
    for action in (lambda: bad.collect(), lambda: bad.count(), lambda: bad.select("otp_pm").collect()):
        with pytest.raises(Exception, match=message):
            action()
    with pytest.raises(Exception, match="does not name exactly one row"):
        merged(history.unionByName(history), spark.createDataFrame([(D[0], 0.5, 0.5)], HISTORY)).collect()


def test_updates_are_read_once(spark, history, tmp_path):
    spark.createDataFrame([(D[1], 0.9, 0.8)], HISTORY).write.parquet(f"{tmp_path}/updates")
    result = merged(history, spark.read.parquet(f"{tmp_path}/updates"))
    assert result._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_publish_update_keeps_the_history_if_a_date_is_unknown(spark, history, tmp_path, monkeypatch):
    folder = tmp_path.as_uri()
    first = publish(history, folder)
    summary = spark.createDataFrame([("03/01/2024", 0.9, 0.8)], "otp_date string, otp_am double, otp_pm double")
    monkeypatch.setattr(update, "otp_summary", lambda report: report)
    second = update.publish_update(folder, summary)
    assert read_published(spark, folder).filter(F.col("otp_date") == D[0]).first().otp_am == 0.9
    with pytest.raises(Exception, match="does not name exactly one row"):
        update.publish_update(folder, summary.withColumn("otp_date", F.lit("03/09/2024")))
    assert versions(spark, folder) == [first, second]
