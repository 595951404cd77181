"""Every registered query against its SQL, on the smallest tables."""

import pytest

from checks.compare import difference, duck
from checks.oracle import ORACLE
from checks.queries import QUERIES
from conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, name, SF_DIR) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).limit(1).collect()
    assert contract.queries().keys() >= QUERIES.keys()
    assert contract.oracle_sql().items() >= ORACLE.items()
