import os

import pytest

import __spark_entry__ as entry
import oracle
import workload
from compare import connect, spark_side, sql_side

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(workload.QUERIES) == set(oracle.SQL)
    assert set(entry.queries()) >= set(workload.QUERIES)
    assert set(entry.oracle_sql()) >= set(oracle.SQL)


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query_equals_sql(spark, con, name):
    expected = sql_side(con, oracle.SQL[name])
    assert spark_side(workload.QUERIES[name](spark, SF_DIR)) == expected
    # "top" may keep nothing where no part has 30 reviews, and so on: rows must exist here.
    assert expected[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
