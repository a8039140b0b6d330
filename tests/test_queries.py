"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import difference
from tests.conftest import SMALL


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.ORACLES)


@pytest.mark.parametrize("name", list(entry.ORACLES))
def test_query(spark, name):
    assert difference(spark, SMALL, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
