"""Every query with SQL gives the same columns, types, rows and values as DuckDB."""

import pytest

from __spark_entry__ import entry
from aerolens.plans.queries import ORACLE, QUERIES
from tests.conftest import DATA
from tests.oracle import compare, duck

SF = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SF), connection, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
