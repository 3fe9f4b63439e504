"""Stored tables, the ingest stream, the monitor and the dashboard."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerolens.operators import alerts, joins, outliers
from aerolens.plans import monitor
from aerolens.plans.dashboard import Dashboard
from aerolens.plans.monitor import run_cycle
from aerolens.plans.store import Store
from aerolens.session import scratch_path
from aerolens.sources.tables import (
    append_readings, partition_column, scan_readings, upsert_partitions, with_partition, write_partitioned,
)
from aerolens.sources.testviews import EVENTS, readings_from_events
from aerolens.streaming.ingest import run_ingest_stream

WEEK = 7 * 24 * 60


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def ingest(spark, landing, store, files=1):
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(landing)
    run_ingest_stream(spark, readings_from_events(stream), store, trigger={"availableNow": True}).awaitTermination()


@pytest.fixture(scope="module")
def ingested(spark):
    """Three files through the stream; the second repeats some rows of the first."""
    from aerolens.sources.testviews import TestTables
    from tests.conftest import DATA

    tables = TestTables(spark, str(DATA / "sf0.001"))
    landing = scratch_path(spark, "landing")
    # Files are read in the order of their times of writing.
    for low, high in ((0, 300), (299, 600), (600, 1000)):
        tables.events.where(f"event_id between {low} and {high - 1}").coalesce(1).write.mode("append").parquet(landing)
    store = Store(spark, scratch_path(spark, "store"), "day")
    ingest(spark, landing, store)
    return tables, landing, store


def batches(spark, store):
    return spark.read.parquet(store.path("readings"))


def test_stream_stores_every_reading_once(spark, ingested):
    tables, _, store = ingested
    stored = batches(spark, store)
    assert rows(stored.select("record_id", "pm25", "ts")) == rows(tables.readings.select("record_id", "pm25", "ts"))
    assert stored.select("batch_id").distinct().count() == 3


def test_stream_alerts_equal_batch_by_batch(spark, ingested):
    tables, _, store = ingested
    columns = ["record_id", "alert_type", "severity", "message"]
    got = store.alerts()
    assert rows(got.where("alert_type <> 'Outlier Detected'").select(*columns)) == rows(
        alerts.threshold_alerts(tables.readings).select(*columns)
    )
    expected = []
    for batch_id in range(3):
        batch = batches(spark, store).where(F.col("batch_id") == batch_id)
        expected += rows(alerts.batch_outlier_alerts(outliers.zsum_outliers(batch)).select(*columns))
    assert rows(got.where("alert_type = 'Outlier Detected'").select(*columns)) == sorted(expected, key=repr)


def test_stream_predicts_and_reports(ingested):
    tables, _, store = ingested
    assert store.predictions().count() == tables.readings.count()
    assert store.predictions().select("record_id").distinct().count() == tables.readings.count()
    names = {r.metric_name for r in store.metrics().collect()}
    assert names == {
        "avg_pm25_batch", "anomaly_count", "stream_model_accuracy", "ingest_throughput", "ingest_latency"
    }
    assert store.metrics().select("metric_id").distinct().count() == store.metrics().count() == 15


def test_restart_adds_nothing(spark, ingested):
    tables, landing, store = ingested
    before = rows(store.alerts().select("record_id", "alert_type"))
    ingest(spark, landing, store)
    assert rows(store.alerts().select("record_id", "alert_type")) == before
    assert batches(spark, store).count() == tables.readings.count()


def test_replayed_batch_replaces_itself(spark, small):
    path = scratch_path(spark, "replay")
    for batch_id in (0, 1, 1):
        append_readings(small.readings.where(F.col("record_id") % 2 == batch_id), path, batch_id)
    assert spark.read.parquet(path).count() == small.readings.count()


def test_scan_prunes_months(spark, frame):
    path = scratch_path(spark, "months")
    many = frame(*[{"ts": dt.datetime(2024, month, 15)} for month in range(1, 7)])
    write_partitioned(many, path)
    scanned = scan_readings(
        spark, path, minutes=31 * 24 * 60, as_of=dt.datetime(2024, 6, 16), columns=["record_id"], schema=many.schema
    )
    assert sorted(r.record_id for r in scanned.collect()) == [5]
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "(ts_day#" in plan.split("PartitionFilters")[1].split("]")[0] and "GreaterThanOrEqual(ts," in plan
    assert scan_readings(spark, path, minutes=1, schema=many.schema).count() == 1  # from the newest reading back
    assert spark.read.parquet(path).select("ts_day").distinct().count() == 6


def test_upsert_rewrites_touched_partitions_only(spark, small):
    path, day = scratch_path(spark, "upsert"), partition_column("day")
    columns = ["record_id", "aqi_pred", "predicted_at"]
    old = with_partition(small.predictions.select(*columns), "day", "predicted_at")
    schema = small.predictions.select(*columns).schema
    upsert_partitions(spark, path, old, schema, ["record_id"], [F.desc("predicted_at")], day)
    files = {r[0] for r in spark.read.parquet(path).where(f"{day} < 20240110").select(F.input_file_name()).distinct().collect()}
    new = old.where(f"{day} >= 20240110").withColumn("aqi_pred", F.lit("New"))
    for _ in range(2):  # again, as after a failure
        upsert_partitions(spark, path, new, schema, ["record_id"], [F.desc("predicted_at")], day)
    after = spark.read.parquet(path)
    assert {r[0] for r in after.where(f"{day} < 20240110").select(F.input_file_name()).distinct().collect()} == files
    assert after.count() == old.count()
    assert after.where("aqi_pred = 'New'").count() == new.count()


@pytest.fixture(scope="module")
def monitored(spark):
    from aerolens.sources.testviews import TestTables
    from tests.conftest import DATA

    tables = TestTables(spark, str(DATA / "sf0.001"))
    store = Store(spark, scratch_path(spark, "monitor"), "day")
    write_partitioned(tables.readings, store.path("readings"))
    for name in ("stations", "sensors"):
        getattr(tables, name).write.parquet(store.path(name))
    as_of = store.latest()
    reports = [
        run_cycle(spark, store, cycle=cycle, as_of=as_of, outlier_window=2 * WEEK, ml_window=2 * WEEK, trees=20)
        for cycle in (1, 2, 2)
    ]
    return tables, store, reports


def test_cycles_work(monitored):
    _, store, reports = monitored
    assert [r.errors for r in reports] == [{}, {}, {}]
    assert all(r.outliers > 0 and r.predictions > 20 for r in reports)
    # The second and the repeated cycle look at the same window, so they add no alerts.
    assert store.alerts().count() == reports[0].outliers
    assert store.alerts().select("record_id", "alert_type").distinct().count() == reports[0].outliers
    assert store.predictions().count() == reports[0].predictions


def test_cycle_metrics_are_kept(monitored):
    _, store, reports = monitored
    values = {
        (r.batch_id, r.metric_name): r.metric_value for r in store.metrics().collect()
    }
    assert len(values) == 12 and store.metrics().count() == 12
    assert values[2, "total_cycles"] == 2
    assert values[2, "avg_outliers_per_cycle"] == (reports[0].outliers + reports[2].outliers) / 2


def test_dashboard(monitored):
    tables, store, _ = monitored
    page = Dashboard(store)
    shown = page.readings(WEEK, 50)
    assert shown.count() == 50 and shown.where("city_zone is null").count() == 0
    assert page.readings_full(WEEK, 50).count() == 50
    kpis = page.key_figures(WEEK, 50).first()
    assert kpis.total_records == 50
    assert page.alerts().count() == min(200, store.alerts().count())
    assert sum(r.open_alerts for r in page.severity_counts().collect()) == page.alerts().count()
    lineage = page.lineage(2 * WEEK)
    alone = joins.reading_lineage(
        store.readings(2 * WEEK, page.as_of), store.stations(), store.sensors(), store.predictions(), store.alerts()
    )
    assert rows(lineage.select("record_id", "aqi_pred", "alert_type")) == rows(
        alone.select("record_id", "aqi_pred", "alert_type")
    )
    assert page.latest_per_station(WEEK, 50).count() > 0
    assert page.metrics().count() == 12


def test_simple_profile(spark, small):
    store = Store(spark, scratch_path(spark, "simple"), "day")
    write_partitioned(small.readings, store.path("readings"))
    report = run_cycle(
        spark, store, cycle=1, outlier_window=2 * WEEK, ml_window=2 * WEEK, profile=monitor.SIMPLE, trees=20
    )
    assert report.errors == {} and report.outliers > 0 and report.predictions > 50
    assert {r.detection_method for r in store.alerts().collect()} == {"IsolationForest"}
    assert {r.severity for r in store.alerts().collect()} <= {"Critical", "High"}


def test_stations_are_added_once(spark, small):
    store = Store(spark, scratch_path(spark, "stations"))
    places = small.stations.where("station_id < 6 and latitude is not null").withColumn("status", F.lit("Active"))
    for batch_id in (0, 0, 1):
        store.add_stations(places, batch_id)
    assert store.stations().count() == places.count()


def test_monitor_replaces_streamed_predictions(spark, ingested):
    _, _, store = ingested
    target = Store(spark, scratch_path(spark, "both"), "day")
    streamed = store.predictions()
    target.append_predictions(streamed, 0)
    target.upsert_predictions(streamed.where("record_id < 10").withColumn("aqi_pred", F.lit("New")))
    assert target.predictions().count() == streamed.count()
    assert {r.record_id for r in target.predictions().where("aqi_pred = 'New'").collect()} == set(range(10))


def test_forest_baseline(spark, small):
    from aerolens.operators.forest import fit_isolation_forest
    from aerolens.streaming.ingest import detect_batch

    batch = small.readings.where("pm25 is not null and co2_ppm is not null")
    baseline = tuple(fit_isolation_forest(batch, [c], trees=20) for c in ("pm25", "co2_ppm"))
    rows_in = batch.count()
    flagged = detect_batch(batch, rows_in, baseline)
    # Strictly above the interpolated 98th percentile lie at most this many rows.
    most = rows_in - 1 - int((rows_in - 1) * 0.98)
    assert 0 < flagged.where("is_anomaly").count() <= most
    assert flagged.agg(F.max("anomaly_score")).first()[0] < 1
    assert detect_batch(batch, 19, baseline).agg(F.max("anomaly_score")).first()[0] > 1


def test_failing_step_does_not_stop_the_cycle(spark, monitored, monkeypatch):
    _, store, _ = monitored

    def fails(*_):
        raise RuntimeError("no forest today")

    monkeypatch.setattr(monitor, "detect_step", fails)
    report = run_cycle(spark, store, cycle=3, outlier_window=WEEK, ml_window=2 * WEEK, trees=5)
    assert report.errors == {"detect": "no forest today"}
    assert report.predictions > 0


def test_small_window_is_skipped(spark, monitored):
    _, store, _ = monitored
    report = run_cycle(spark, store, cycle=4, outlier_window=60, ml_window=60)
    assert (report.outliers, report.predictions, report.errors) == (0, 0, {})


def test_empty_store(spark):
    store = Store(spark, scratch_path(spark, "empty"))
    assert store.latest() is None
    assert run_cycle(spark, store, cycle=1).outliers == 0


def test_late_and_repeated_rows(spark, frame):
    """A copy within the lateness is dropped; late and future-dated rows are kept."""
    from pyspark.sql import types as T

    from aerolens.schema import READINGS

    at = dt.datetime(2024, 1, 1, 12)
    first = frame(*[{"record_id": i, "ts": at + dt.timedelta(seconds=i)} for i in range(30)])
    second = frame(
        {"record_id": 5, "ts": at + dt.timedelta(seconds=5)},  # copy
        {"record_id": 100, "ts": at - dt.timedelta(seconds=30)},  # late
        {"record_id": 101, "ts": at + dt.timedelta(hours=1)},  # ahead of time
    )
    landing = scratch_path(spark, "late")
    for part in (first, second):
        part.coalesce(1).write.mode("append").parquet(landing)
    schema = T.StructType([f for f in READINGS.fields if f.name in first.columns])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    store = Store(spark, scratch_path(spark, "store"))
    run_ingest_stream(spark, stream, store, trigger={"availableNow": True}).awaitTermination()
    ids = sorted(r.record_id for r in spark.read.parquet(store.path("readings")).collect())
    assert ids == [*range(30), 100, 101]
