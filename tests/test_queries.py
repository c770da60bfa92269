"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import duck, duck_result, spark_result

import __spark_entry__ as registry
from millrace.plans.oracles import ORACLES
from millrace.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    names, got = spark_result(registry.queries()[name](spark, FOLDER))
    sql_names, expected, _ = duck_result(con, registry.oracle_sql()[name])
    assert names == sql_names
    assert got == expected

