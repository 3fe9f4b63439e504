"""Physical plans that must hold at any size."""

import pytest

from aerolens.plans.queries import QUERIES
from tests.conftest import DATA

SF = str(DATA / "sf0.001")

# Queries whose result is one row, a top-k or a bounded table, and which run eagerly when called.
EAGER = {
    "scan_readings", "write_partitioned", "append_readings", "upsert_predictions", "stream_readings",
    "stream_zone_windows", "run_ingest_stream", "run_monitor_cycle", "isolation_forest_score",
    "stream_forest_outliers", "monitor_anomalies", "train_aqi_model", "update_aqi_model", "score_aqi",
    "ingest_readings", "quarantine_readings", "monitor_cycle_counts", "model_state_moments", "score_aqi_consistent",
}


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_global_window(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for line in text.splitlines():
        if "Window [" in line and "WindowGroupLimit" not in line:
            assert ", [], [" not in line, line


@pytest.mark.parametrize("name", ["latest_per_station", "insert_if_absent"])
def test_first_row_per_key_is_taken_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


def test_newest_rows_are_a_top_k(spark):
    text = plan(spark, "dashboard_readings")
    assert "TakeOrderedAndProject(limit=1000" in text
    assert "hashpartitioning" not in text and "rangepartitioning" not in text


def test_projection_reaches_the_scan(spark):
    text = plan(spark, "aqi_bucket")
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in text


def test_statistics_leave_plain_numbers(spark, small):
    from aerolens.operators import outliers
    from aerolens.operators.statistics import imputed_moments, settled

    moments = settled(imputed_moments(small.readings, ["pm25"]))
    flagged = outliers.zscore_outliers(small.readings, ["pm25"], moments=moments)
    assert "Subquery" not in flagged._jdf.queryExecution().executedPlan().toString()
