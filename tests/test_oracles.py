"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import bag, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_counterpart_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF)
    result = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert bag(df.columns, df.collect()) == bag(columns, result.fetchall())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["conv_id", "text"] and df.count() > 0
