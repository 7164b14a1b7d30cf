import pytest

import __spark_entry__
from checks.compare import connect, difference
from checks.oracles import all_oracles
from checks.queries import all_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark):
    found = __spark_entry__.entry(spark)
    assert found.columns == ["word", "count"]
    assert found.count() > 0


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_its_sql(spark, connection, name):
    assert difference(spark, connection, FOLDER, name) == ""
