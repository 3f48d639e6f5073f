"""Registered queries against their SQL, on the smallest tables."""

import os

import pytest

from oracle_check import compare, connect
from sensorpipe.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", list(queries.SQL))
def test_query(spark, name):
    assert compare(queries.names()[name](spark, SF).toPandas(), connect(SF).sql(queries.SQL[name]).df()) is None
