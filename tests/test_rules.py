"""Edges of the rules, on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerolens.functions import ladders, text
from aerolens.operators import aggregates, alerts, derive, filters, joins, keyed, outliers, quality, series
from aerolens.schema import SENSOR_STATUSES, SEVERITIES


def column(df, name):
    return [row[name] for row in df.orderBy("record_id").collect()]


def test_bucket_limits_are_inclusive(frame):
    values = [None, 0.0, 12.0, 12.01, 35.0, 35.01, 55.0, 55.01]
    buckets = column(derive.with_aqi_bucket(frame(*[{"pm25": v} for v in values])), "aqi_bucket")
    assert buckets == [None, "Good", "Good", "Moderate", "Moderate", "Unhealthy", "Unhealthy", "Hazardous"]


def test_status_ladders(frame):
    rows = frame(
        {"pm25": 100.01}, {"co2_ppm": 850.0}, {"co2_ppm": 850.01}, {"pm25": 35.01}, {"co2_ppm": 600.0},
        {"pm25": None, "co2_ppm": 700.01}, {"pm25": None, "co2_ppm": None},
    )
    assert column(derive.with_reading_status(rows), "status") == [
        "Critical", "Alert", "Critical", "Warning", "Normal", "Alert", "Normal"
    ]
    three = derive.with_reading_status(rows, ladders.STATUS_3)
    assert column(three, "status") == ["Alert", "Alert", "Alert", "Normal", "Normal", "Warning", "Normal"]


def test_threshold_alerts(frame):
    raised = alerts.threshold_alerts(
        frame(
            {"pm25": 55.0}, {"pm25": 55.01}, {"pm25": 100.0}, {"pm25": 100.01},
            {"pm25": 120.0, "co2_ppm": 800.01}, {"pm25": None, "co2_ppm": 900.0}, {"pm25": 10.0, "co2_ppm": 800.0},
        )
    )
    assert {(r.record_id, r.alert_type, r.severity) for r in raised.collect()} == {
        (1, "PM2.5 Alert", "High"), (2, "PM2.5 Alert", "High"), (3, "High PM2.5", "Critical"),
        (4, "High PM2.5", "Critical"), (4, "CO₂ Alert", "Moderate"), (5, "CO₂ Alert", "Moderate"),
    }
    both = {r.alert_type: r for r in raised.where("record_id = 4").collect()}
    assert both["High PM2.5"].message == "PM2.5 120.0 µg/m³" and both["High PM2.5"].anomaly_score == 1.2
    assert both["CO₂ Alert"].message == "CO₂ 800 ppm"


def test_high_alerts(frame):
    raised = alerts.pm25_high_alerts(frame(*[{"pm25": v} for v in (50.0, 50.01, 75.0, 75.01, 100.0, 100.01, None)]))
    assert column(raised, "severity") == ["Moderate", "Moderate", "High", "High", "Critical"]


def test_anomaly_alerts(frame):
    rows = frame(
        {"pm25": 150.01}, {"pm25": 150.0}, {"co2_ppm": 1000.01}, {"co2_ppm": 800.01}, {"co2_ppm": 600.01},
        {"temperature_c": None}, {},
    ).withColumns(
        {
            "is_statistical_outlier": F.expr("record_id in (0, 1, 3)"),
            "is_isolation_outlier": F.expr("record_id in (0, 2, 3, 4, 5)"),
        }
    )
    raised = alerts.anomaly_alerts(rows)
    assert column(raised, "severity") == ["Critical", "High", "Critical", "High", "Moderate", "Low"]
    assert column(raised, "anomaly_score") == [1.0, 0.8, 0.8, 1.0, 0.8, 0.8]
    assert column(raised, "detection_method")[:3] == ["Statistical|IsolationForest", "Statistical", "IsolationForest"]
    assert column(raised, "message")[5] == "Anomaly detected at station 1: PM2.5=10.0μg/m³, CO2=450ppm, Temp=nan°C"


def test_simple_anomaly_alerts(frame):
    rows = frame({"pm25": 100.01}, {"co2_ppm": 800.0}, {"co2_ppm": 800.01}).withColumn("is_outlier", F.lit(True))
    raised = alerts.anomaly_alerts_simple(rows)
    assert column(raised, "severity") == ["Critical", "High", "Critical"]
    assert column(raised, "message")[0] == "Anomaly detected: PM2.5=100.0, CO2=450ppm"


def test_halves_round_up(spark):
    got = spark.sql(
        f"select {text.fixed_decimals('0.25D', 1)} a, {text.fixed_decimals('0.35D', 1)} b,"
        f" {text.fixed_decimals('450.5D', 0)} c, {text.fixed_decimals('cast(null as double)', 1)} d"
    ).first()
    assert tuple(got) == ("0.3", "0.4", "451", "nan")


def test_constant_column_has_no_outliers(frame):
    rows = frame(*[{"pm25": 0.1, "co2_ppm": None if i == 0 else 0.3} for i in range(30)])
    assert outliers.zscore_outliers(rows).where("is_statistical_outlier").count() == 0


def test_single_row_and_empty(frame):
    assert column(outliers.zscore_outliers(frame({})), "is_statistical_outlier") == [False]
    assert column(outliers.zsum_outliers(frame({})), "is_anomaly") == [False]
    nothing = frame({}).where("false")
    assert outliers.zscore_outliers(nothing).count() == 0
    assert outliers.percentile_outliers(nothing, "pm25").count() == 0
    kpis = aggregates.kpi_summary(nothing, empty_alerts(nothing)).first()
    assert tuple(kpis) == (None, None, None, 0, 0)
    assert set(aggregates.kpi_bands(aggregates.kpi_summary(nothing, empty_alerts(nothing))).first()) == {None, "green"}


def empty_alerts(df):
    return df.selectExpr("'Open' as status").where("false")


def test_percentile_is_strict(frame):
    rows = frame(*[{"pm25": float(min(i, 98))} for i in range(101)])
    assert outliers.percentile_outliers(rows, "pm25").where("is_anomaly").count() == 0


def test_validation(frame):
    rows = frame(
        {}, {"humidity": 101.0}, {"pm25": -0.1}, {"wind_direction": 360.0}, {"wind_direction": 360.5, "pm25": -1.0},
        {"pm25": None, "humidity": None}, {"data_quality_score": 1.01},
    )
    checked = quality.validate_readings(rows)
    assert [list(v) for v in column(checked, "violations")] == [
        [], ["humidity_range"], ["pm25_range"], [], ["pm25_range", "wind_direction_range"], [],
        ["data_quality_score_range"],
    ]
    assert quality.good_rows(checked).count() + quality.quarantine_rows(checked).count() == rows.count()


def test_missing_key_is_a_violation(frame):
    rows = frame({}).withColumn("station_id", F.lit(None).cast("bigint"))
    assert column(quality.validate_readings(rows), "violations") == [["station_id_missing"]]


def test_long_text_is_a_violation(frame):
    rows = frame({}).withColumn("status", F.lit("x" * 21))
    assert column(quality.validate_readings(rows), "violations") == [["status_length"]]


def test_open_alerts_reads_both_layouts(spark):
    older = spark.createDataFrame([(1, False), (2, True)], "alert_id int, is_resolved boolean")
    assert [r.alert_id for r in filters.open_alerts(older).collect()] == [1]
    assert filters.open_alerts(older.select("alert_id")).count() == 2


def test_conform(spark):
    older = spark.sql("select 7L as reading_id, 1.005D as pm25, 1e12D as co2_ppm, 33.335D as humidity_percent")
    row = quality.conform_readings(older).first()
    assert (row.record_id, str(row.pm25), row.co2_ppm, str(row.humidity)) == (7, "1.01", None, "33.34")
    assert (row.status, row.data_quality_score) == ("Normal", 1.0)
    explicit = quality.conform_readings(spark.sql("select cast(null as string) as status, cast(null as double) as data_quality_score"))
    assert tuple(explicit.first()) == (None, None)


def test_orphans_and_duplicates(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, station_id int")
    parent = spark.createDataFrame([(1,), (2,)], "station_id int")
    assert [r.id for r in quality.orphan_rows(child, parent, "station_id").collect()] == [2]
    keys = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("b", None)], "z string, k int")
    assert [tuple(r) for r in quality.duplicate_keys(keys, ["z", "k"]).collect()] == [("a", 1, 2)]


def test_enums(spark):
    df = spark.createDataFrame([("Active",), ("Broken",), (None,)], "status string")
    assert [r.status for r in quality.enum_violations(df, "status", SENSOR_STATUSES).collect()] == ["Broken"]
    checked = {r.value: (r["rank"], r.is_declared) for r in quality.enum_check(df, "status", SENSOR_STATUSES).collect()}
    assert checked == {"Active": (1, True), "Broken": (None, False)}
    ranks = spark.createDataFrame([(s,) for s in SEVERITIES], "severity string").selectExpr(ladders.severity_rank())
    assert [r[0] for r in ranks.collect()] == [1, 2, 3, 4]


def test_guard(frame):
    rows = frame(*[{}] * 20)
    assert filters.min_rows_guard(rows, 20).count() == 20
    assert filters.min_rows_guard(rows, 21).count() == 0


def test_recent_keeps_the_future(frame):
    rows = frame(*[{}] * 10)  # one per minute
    kept = filters.recent(rows, 2, dt.datetime(2024, 1, 1, 0, 5))
    assert column(kept, "record_id") == [3, 4, 5, 6, 7, 8, 9]


def test_ties_go_to_the_larger_key(frame, spark):
    same = dt.datetime(2024, 1, 1)
    rows = frame({"ts": same, "pm25": 1.0}, {"ts": same, "pm25": 2.0}, {"ts": same, "pm25": 3.0, "station_id": 2})
    places = spark.sql("select 1L as station_id, 'A' as city_zone, 1D as latitude, 1D as longitude"
                       " union all select 2L, 'B', null, 2D")
    latest = series.latest_per_station(rows, places).collect()
    assert [(r.station_id, r.record_id) for r in latest] == [(1, 1)]
    assert [r.record_id for r in joins.newest_readings(rows, 2).collect()] == [2, 1]


def test_limit_before_and_after_the_join(frame, spark):
    rows = frame({"station_id": 1}, {"station_id": 1}, {"station_id": 9})  # the newest has no station
    places = spark.sql("select 1L as station_id, 'A' as city_zone, 1D as latitude, 1D as longitude")
    none = spark.sql("select 0L as record_id, 'Good' as aqi_pred, 1D as proba_good, 0D as proba_moderate,"
                     " 0D as proba_unhealthy, 0D as proba_hazardous, 1D as confidence_score, 'v' as model_version")
    first = joins.dashboard_readings(rows, places, none, 2)
    assert [r.record_id for r in first.collect()] == [1]
    last = joins.dashboard_readings_full(rows, places, none, 2)
    assert [(r.record_id, r.aqi_pred) for r in last.collect()] == [(1, None), (0, "Good")]


def test_severity_counts_lists_all_levels(spark):
    df = spark.createDataFrame([("High", "Open"), ("High", "Open"), ("Low", "Resolved")], "severity string, status string")
    assert dict(aggregates.severity_counts(df).collect()) == {"Low": 0, "Moderate": 0, "High": 2, "Critical": 0}


def metrics(spark, rows):
    return spark.createDataFrame(rows, "metric_id bigint, metric_name string, metric_value double, metric_unit string, recorded_at timestamp")


def test_metric_series_takes_names_before_it_drops_single_points(spark):
    day = dt.datetime(2024, 1, 1)
    rows = metrics(spark, [
        (1, "old", 1.0, "u", day), (2, "old", 2.0, "u", day + dt.timedelta(1)),
        (3, "new", 3.0, "u", day + dt.timedelta(2)), (4, "single", 4.0, "u", day + dt.timedelta(4)),
        (5, "new", 5.0, "u", day + dt.timedelta(3)),
    ])
    assert [r.metric_name for r in series.metric_series(rows, 100, 2).collect()] == ["new", "new"]


def test_missing_time_counts_as_newest(spark):
    rows = metrics(spark, [(1, "a", 1.0, "u", dt.datetime(2024, 1, 1)), (2, "a", 1.0, "u", None)])
    assert [r.metric_id for r in keyed.retain_latest_metrics(rows, 1).collect()] == [2]
    assert [r.metric_id for r in keyed.expired_metrics(rows, 1).collect()] == [1]


def test_metric_display(spark):
    rows = metrics(spark, [(1, "ingest_latency", 1.005, "ms", dt.datetime(2024, 1, 2, 3, 4, 5))])
    shown = derive.metric_display(rows).first()
    assert tuple(shown)[1:] == ("Ingest Latency", "1.01 ms", "2024-01-02 03:04:05")


def test_select_available(frame):
    assert derive.select_available(frame({}), ["pm25", "nothing", "ts"]).columns == ["pm25", "ts"]


def test_cascade(spark):
    stations = spark.sql("select explode(array(1L, 2L)) as station_id")
    sensors = spark.sql("select * from values (10L, 1L), (20L, 2L) as t(sensor_id, station_id)")
    readings = spark.sql("select * from values (100L, 1L, 10L), (200L, 2L, 20L), (201L, 2L, 10L) as t(record_id, station_id, sensor_id)")
    raised = spark.sql("select * from values (1L, 100L, 1L), (2L, 200L, 2L), (3L, 201L, 2L) as t(alert_id, record_id, station_id)")
    left = keyed.cascade_delete(
        stations.where("station_id = 1"),
        {"stations": stations, "sensors": sensors, "readings": readings, "alerts": raised,
         "predictions": raised.select("record_id", "station_id")},
    )
    assert [r.record_id for r in left["readings"].collect()] == [200]
    assert [r.alert_id for r in left["alerts"].collect()] == [2]
    assert left["predictions"].columns == ["record_id", "station_id"] and left["predictions"].count() == 1
    for name, df in left.items():
        key = df.columns[0]
        assert df.join(stations.where("station_id = 1"), "station_id", "left_semi").count() == 0, (name, key)


def test_insert_and_upsert_are_idempotent(spark):
    old = spark.sql("select * from values (1L, 'a'), (2L, 'b') as t(k, v)")
    new = spark.sql("select * from values (2L, 'x'), (3L, 'y'), (3L, 'z') as t(k, v)")
    order = [F.desc("v")]
    once = keyed.insert_if_absent(old, new, ["k"], order)
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "b"), (3, "z")]
    assert sorted(map(tuple, keyed.insert_if_absent(once, new, ["k"], order).collect())) == sorted(map(tuple, once.collect()))
    replaced = keyed.upsert(old, new, ["k"], order)
    assert sorted(map(tuple, replaced.collect())) == [(1, "a"), (2, "x"), (3, "z")]
    assert sorted(map(tuple, keyed.upsert(replaced, new, ["k"], order).collect())) == sorted(map(tuple, replaced.collect()))


def test_zone_windows_need_whole_slides(frame):
    with pytest.raises(ValueError):
        series.zone_windows(frame({}), 10, 3)
