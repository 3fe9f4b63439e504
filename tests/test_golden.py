"""Counts that FIXTURES.md lists for scale factor 0.01."""

import pytest
from pyspark.sql import functions as F

from aerolens.operators import alerts, derive, filters, joins, outliers, series
from aerolens.operators.statistics import exact_quantiles

WEEK = 7 * 24 * 60


@pytest.fixture
def window(medium):
    return filters.quality_gate(filters.recent(derive.with_aqi_bucket(medium.readings), WEEK))


def test_known_values(medium):
    row = medium.readings.agg(
        F.count("*"), F.count("pm25"), F.count("co2_ppm"), F.count("temperature_c"), F.count("pm10")
    ).first()
    assert tuple(row) == (10000, 7983, 8018, 9411, 9230)


def test_buckets(medium):
    counts = dict(derive.with_aqi_bucket(medium.readings).groupBy("aqi_bucket").count().collect())
    assert counts == {"Good": 1720, "Moderate": 2330, "Unhealthy": 1288, "Hazardous": 2645, None: 2017}


def test_alerts(medium):
    raised = medium.alerts.groupBy("severity").agg(F.count("*"), F.count_if(F.col("status") == "Open")).collect()
    assert {r[0]: (r[1], r[2]) for r in raised} == {
        "Critical": (1055, 802), "High": (1590, 1190), "Moderate": (1580, 1176)
    }
    assert alerts.pm25_high_alerts(medium.readings).count() == 2908


def test_window(window):
    assert window.count() == 825
    medians = exact_quantiles(window, ["pm10", "temperature_c"]).first()
    assert (round(medians[0], 6), medians[1]) == (47.088, 17.0)


def test_outliers(window):
    assert outliers.zscore_outliers(window).where("is_statistical_outlier").count() == 17
    scores = outliers.zsum_outliers(window)
    assert scores.where("is_anomaly").count() == 4
    assert round(scores.agg(F.max("anomaly_score")).first()[0], 6) == 10.244527
    assert outliers.percentile_outliers(window, "pm25").where("is_anomaly").count() == 17


def test_latest(medium):
    row = series.latest_per_station(medium.readings, medium.stations).agg(F.count("*"), F.sum("pm25")).first()
    assert (row[0], round(row[1], 2)) == (128, 4840.60)


def test_newest_thousand(medium):
    everything = filters.recent(medium.readings, 365 * 24 * 60)
    shown = joins.dashboard_readings(everything, filters.active_stations(medium.stations), medium.predictions)
    assert tuple(shown.agg(F.count("*"), F.sum("record_id")).first()) == (899, 8538956)


def test_dimensions(medium):
    assert medium.sensors.count() == 7500
    assert medium.sensors.where("status = 'Active'").count() == 6819
    assert joins.active_sensors(medium.stations, medium.sensors).count() == 6139
    assert medium.predictions.count() == 7983


def test_metrics(medium):
    row = medium.system_metrics.agg(F.count("*"), F.sum("metric_value")).first()
    assert (row[0], round(row[1], 4)) == (90, 20280.3524)


def test_lineage_fans_out(medium):
    rows = joins.reading_lineage(
        medium.readings, medium.stations, medium.sensors, medium.predictions, medium.alerts
    )
    assert tuple(rows.agg(F.count("*"), F.count("alert_type")).first()) == (10370, 4225)
