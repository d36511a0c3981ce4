"""Every registered query with a SQL twin against DuckDB."""

import pytest

import __spark_entry__ as engine
from checks.compare import connect, difference

QUERIES, ORACLE = engine.queries(), engine.oracle_sql()


@pytest.fixture(scope="module")
def database(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, folder, database, name):
    found = QUERIES[name](spark, folder).toPandas()
    wanted = database.execute(ORACLE[name]).df()
    assert difference(found, wanted) is None


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert engine.entry(spark).count() > 0
