"""Lineage over spans that are stored in buckets."""

import datetime as dt

import pytest

from aerolens.operators.joins import reading_lineage
from aerolens.plans import history
from aerolens.plans.queries import store_of
from aerolens.plans.store import Store
from aerolens.session import scratch_path

DAYS = dt.timedelta(days=12)


@pytest.fixture(scope="module")
def written(spark):
    from aerolens.sources.testviews import TestTables
    from tests.conftest import DATA

    tables = TestTables(spark, str(DATA / "sf0.001"))
    store = store_of(tables)
    end = store.latest()
    history.write_history(store, end - DAYS, end, version=1, buckets=4)
    return tables, store, end


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def expected(tables, end):
    window = tables.readings.where(f"ts >= timestamp '{end - DAYS}' and ts < timestamp '{end}'")
    return rows(reading_lineage(window, tables.stations, tables.sensors, tables.predictions, tables.alerts))


def test_rows_are_those_of_the_plain_lineage(written):
    tables, store, end = written
    got = rows(history.history_lineage(store))
    assert got == expected(tables, end) and len(got) > 0


def test_no_large_side_is_shuffled(spark, written):
    _, store, _ = written
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = history.side_by_side(history.history(store))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
        assert joined.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_version_counts_once_it_is_whole(spark, written, monkeypatch):
    tables, store, end = written
    before = rows(history.history_lineage(store))
    lost = dict(history.TABLES) | {"alerts": "record_id bigint, no_such_column string"}
    with monkeypatch.context() as patch:
        patch.setattr(history, "TABLES", lost)
        with pytest.raises(Exception, match="no_such_column"):
            history.write_history(store, end - dt.timedelta(days=1), end, version=2, buckets=2)
    assert rows(history.history_lineage(store)) == before
    history.write_history(store, end - DAYS, end, version=2, buckets=3)  # again, with other buckets
    assert rows(history.history_lineage(store)) == before
    history.write_history(store, end - DAYS, end - DAYS, version=3)  # an empty span
    assert history.history_lineage(store).count() == 0


def test_nothing_written(spark):
    assert history.history_lineage(Store(spark, scratch_path(spark, "no-history"))) is None
