"""Every registered query against its SQL, and the registry itself."""

from __future__ import annotations

import pytest
from conftest import SMALL

import __spark_entry__ as entry
from compare import connect, difference
from tripmill.plans import registered

QUERIES = registered.queries()
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}
WITHOUT_SQL = {"location_clusters", "adf_statistic"}


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


def test_every_sql_belongs_to_a_query():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert not set(SQL) - set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 24


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, database, name):
    ours = QUERIES[name](spark, SMALL).toPandas()
    assert difference(ours, database.execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
