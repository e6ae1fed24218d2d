"""Every registered query against its SQL, over whole tables."""

import pytest
from compare import differences, duck
from msgflow.plans.catalog import QUERIES
from msgflow.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, connection, name):
    assert differences(QUERIES[name](spark, sf_dir), connection, ORACLES[name]) == []


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["id", "name", "age"]
