"""Every registered query against its SQL."""

import __spark_entry__ as driver
import oracle
import pytest
from conftest import SF_DIR

QUERIES, ORACLE = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = oracle.connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLE:
        assert oracle.differences(df, con, ORACLE[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
