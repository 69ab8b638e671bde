"""Every query with SQL gives the rows of its SQL; the others run in the job's test."""

import pytest

from oracle import compare, connect

from loamlens.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_flagship(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["state_name", "median_yield"] and df.count() > 0
