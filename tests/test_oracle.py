"""Every registered query against DuckDB on the smallest tables."""

import pytest

from checks.compare import connect, differences
from checks.catalog import QUERIES as CATALOG
from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    own = {name for name in QUERIES if name in CATALOG}
    assert own == set(CATALOG) and own <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query(spark, duck, name):
    assert differences(spark, duck, QUERIES[name], ORACLE[name], SF) is None


def test_entry(spark):
    assert entry(spark).agg({"n": "sum"}).first()[0] == 60
