"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect
from sensorpipe.plans import oracle, queries as catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_sql():
    assert catalog.names().keys() == oracle.SQL.keys()
    assert catalog.names().items() <= entry.queries().items()


@pytest.mark.parametrize("name", list(catalog.names()))
def test_query(spark, db, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert compare(got, db.sql(entry.oracle_sql()[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["ts", "device_id", "domain", "click_median", "click_mean", "view_median", "purchase_mean", "unknown"]
