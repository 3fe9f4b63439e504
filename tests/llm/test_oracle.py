"""Corpus queries with SQL equal DuckDB; the others run over their whole table."""

import duckdb
import pytest

from aerolens.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SF
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    found = QUERIES[name](spark, SF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert compare(found, connection, ORACLE[name]) is None


def test_names():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
