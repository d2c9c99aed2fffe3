"""Every registered query against its DuckDB statement, over whole tables."""

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from kerbside.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) is None


def test_entry(spark):
    report = entry(spark)
    assert len(report.columns) == 34
    assert report.count() > 0
