"""Every registered query against its SQL on another engine."""

import pytest

import __spark_entry__ as entry_point
from shelfwise.plans import oracle
from shelfwise.plans import queries as plans
from tests.compare import difference
from tests.conftest import FOLDER

QUERIES = plans.queries()


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_as_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, entry_point.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.oracle_sql())
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(oracle.oracle_sql()) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry_has_a_stable_schema(spark):
    first, second = entry_point.entry(spark), entry_point.entry(spark)
    assert first.schema == second.schema
    assert first.count() == 6000
