"""What the ingest stores, rejects and recognises, and how stored tables survive repeats and crashes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from aerolens.operators import alerts, keyed
from aerolens.operators.filters import quality_gate
from aerolens.plans.monitor import run_cycle
from aerolens.plans.store import STORED_PREDICTIONS, Store
from aerolens.schema import READINGS
from aerolens.session import scratch_path, shared_folder
from aerolens.sources import folders
from aerolens.sources.tables import STAGE, append_readings, upsert_partitions, with_partition, write_partitioned
from aerolens.streaming.ingest import admit_batch, process_batch, run_ingest_stream

AT = dt.datetime(2024, 1, 1, 12)


def run(spark, parts, store):
    landing = scratch_path(spark, "landing")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(landing)
    schema = T.StructType([f for f in READINGS.fields if f.name in parts[0].columns])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    run_ingest_stream(spark, stream, store, trigger={"availableNow": True}).awaitTermination()


def ids(df):
    return sorted(r.record_id for r in df.select("record_id").collect())


def test_one_future_row_costs_no_others(spark, frame):
    first = frame(*[{"record_id": i, "ts": AT + dt.timedelta(seconds=i)} for i in range(30)],
                  {"record_id": 99, "ts": AT + dt.timedelta(hours=1)})
    second = frame(*[{"record_id": i, "ts": AT + dt.timedelta(seconds=i)} for i in range(25, 60)])  # five copies
    third = frame(*[{"record_id": i, "ts": AT - dt.timedelta(hours=i - 50)} for i in range(60, 90)],
                  {"record_id": 99, "ts": AT + dt.timedelta(hours=1)})
    store = Store(spark, scratch_path(spark, "store"))
    run(spark, [first, second, third], store)
    assert ids(spark.read.parquet(store.path("readings"))) == [*range(90), 99]
    assert store.quarantine().count() == 0


def test_good_and_quarantined_rows_are_all_rows(spark, frame):
    good = [{"record_id": i} for i in range(5)]
    bad = [
        {"record_id": 10, "humidity": 101.0}, {"record_id": 11, "pm25": 1e30}, {"record_id": 12, "pm25": float("nan")},
        {"record_id": 13, "ts": None}, {"record_id": None}, {"record_id": None}, {"record_id": 14, "station_id": 9},
    ]
    store = Store(spark, scratch_path(spark, "store"))
    stations = spark.createDataFrame(
        [(1, "a", "z", 1.0, 1.0, True, "Active")],
        "station_id bigint, station_name string, city_zone string, latitude double, longitude double, is_active boolean, status string",
    )
    store.add_stations(stations, 0)
    assert process_batch(store, frame(*good, *bad), 0) == 5
    assert ids(spark.read.parquet(store.path("readings"))) == [0, 1, 2, 3, 4]
    found = {(r.record_id, r.violations) for r in store.quarantine().collect()}
    assert store.quarantine().count() == len(bad)
    assert found == {
        (10, "humidity_range"), (11, "pm25_overflow"), (12, "pm25_overflow"), (13, "ts_missing"),
        (None, "record_id_missing"), (14, "station_id_orphan"),
    }
    # The stream goes on; two readings come again with their times.
    at = dt.datetime(2024, 1, 1)
    again = [{"record_id": i, "ts": at + dt.timedelta(minutes=i)} for i in range(3, 8)]
    assert process_batch(store, frame(*again), 1) == 3


def test_left_out_quality_score_passes_the_gate(spark, frame):
    batch = frame(*[{"record_id": i} for i in range(4)]).drop("data_quality_score")
    admitted = admit_batch(Store(spark, scratch_path(spark, "store")), batch, 0)
    assert quality_gate(admitted).count() == 4
    assert {r.status for r in admitted.collect()} == {"Normal"}


def test_bulk_history_and_stream_share_a_store(spark, frame):
    store = Store(spark, scratch_path(spark, "store"), "day")
    history = frame(*[{"record_id": i, "ts": AT + dt.timedelta(minutes=i)} for i in range(40)])
    write_partitioned(history, store.path("readings"))
    run(spark, [frame(*[{"record_id": i, "ts": AT + dt.timedelta(minutes=i)} for i in range(35, 50)])], store)
    assert ids(store.readings(10_000)) == list(range(50))


def test_replay_replaces_the_whole_batch(spark, frame):
    path = scratch_path(spark, "replay")
    two = frame({"record_id": 1, "ts": dt.datetime(2024, 1, 5)}, {"record_id": 2, "ts": dt.datetime(2024, 2, 5)})
    append_readings(two, path, 0)
    append_readings(frame({"record_id": 3, "ts": dt.datetime(2024, 3, 5)}), path, 1)
    append_readings(two.where("record_id = 1"), path, 0)
    assert ids(spark.read.parquet(path)) == [1, 3]
    append_readings(two.where("false"), path, 0)
    assert ids(spark.read.parquet(path)) == [3]


def test_crash_between_stage_and_swap(spark, small):
    path, columns = scratch_path(spark, "upsert"), ["record_id", "aqi_pred", "predicted_at"]
    old = with_partition(small.predictions.select(*columns), "day", "predicted_at")
    schema = small.predictions.select(*columns).schema
    order = [F.desc("predicted_at")]
    upsert_partitions(spark, path, old, schema, ["record_id"], order, "ts_day")
    day = old.agg(F.min("ts_day")).first()[0]
    # A crash after the stage was complete and the day's folder was gone.
    whole = old.where(F.col("ts_day") == day).withColumn("aqi_pred", F.lit("Staged"))
    whole.write.partitionBy("ts_day").parquet(f"{path}/{STAGE}")
    folders.remove(spark, f"{path}/ts_day={day}")
    new = old.where(F.col("ts_day") > day).limit(3).withColumn("aqi_pred", F.lit("New"))
    upsert_partitions(spark, path, new, schema, ["record_id"], order, "ts_day")
    after = spark.read.parquet(path)
    assert after.count() == old.count()
    assert after.where("aqi_pred = 'Staged'").count() == whole.count() and after.where("aqi_pred = 'New'").count() == 3
    assert not folders.exists(spark, f"{path}/{STAGE}")


def test_a_reader_does_not_finish_an_upsert(spark, small):
    """It reads the staged partitions in the place of those the writer is about to replace, and writes nothing."""
    store = Store(spark, scratch_path(spark, "store"), "day")
    rows = small.predictions.join(small.readings.select("record_id", "ts"), "record_id").select("record_id", "aqi_pred", "ts")
    full = rows.select(*(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in STORED_PREDICTIONS.fields))
    store.upsert_predictions(full)
    path, count = store.path("predictions"), full.count()
    day = with_partition(full).agg(F.min("ts_day")).first()[0]
    whole = with_partition(full).where(F.col("ts_day") == day).withColumn("aqi_pred", F.lit("Staged"))
    whole.write.partitionBy("ts_day").parquet(f"{path}/{STAGE}")
    folders.remove(spark, f"{path}/ts_day={day}")
    for _ in range(2):
        assert store.predictions().count() == count
        assert store.predictions().where("aqi_pred = 'Staged'").count() == whole.count()
        assert folders.exists(spark, f"{path}/{STAGE}/_SUCCESS") and not folders.exists(spark, f"{path}/ts_day={day}")


def test_metric_ids_do_not_collide_and_retention_covers_all_writers(spark):
    store = Store(spark, scratch_path(spark, "store"))
    for batch in range(2):
        for source in ("ingest", "monitor"):
            many = spark.range(700).selectExpr("concat('m', id) as metric_name", "1.0D as metric_value", "'u' as metric_unit")
            store.append_metrics(many, source, batch, F.expr(f"timestamp'2024-01-0{batch + 1}'"))
    assert store.metrics().select("metric_id").distinct().count() == 2800
    for _ in range(2):
        store.retain_metrics(1000)
        assert {(r.source, r.batch_id) for r in store.metrics().select("source", "batch_id").distinct().collect()} == {
            ("ingest", 1), ("monitor", 1)
        }


def test_models_are_found_by_name(spark):
    from aerolens.operators.model import STATE

    store = Store(spark, scratch_path(spark, "store"))
    assert store.model_before("ingest", 5) is None
    for version in (0, 1, 4):
        store.save_model(spark.createDataFrame([(f"f{version}", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)], STATE), "ingest", version)
    assert store.model_before("ingest", 4).first()["feature"] == "f1"
    assert store.model_before("ingest", 9).first()["feature"] == "f4"


def test_jobs_remove_their_scratch(spark, frame):
    store = Store(spark, scratch_path(spark, "store"), "day")
    before = len(folders.matching(spark, f"{shared_folder(spark)}/aerolens/*"))
    write_partitioned(frame(*[{"record_id": i, "ts": AT + dt.timedelta(minutes=i)} for i in range(60)]), store.path("readings"))
    assert run_cycle(spark, store, cycle=1, trees=5).errors == {}
    # Only the store itself is new.
    assert len(folders.matching(spark, f"{shared_folder(spark)}/aerolens/*")) <= before + 1


def test_null_keys_never_clash(spark):
    schema = "id bigint, zone string, x double"
    new = spark.createDataFrame([(1, "a", 1.0), (2, "a", None), (3, "a", None), (4, "a", 1.0)], schema)
    known = spark.createDataFrame([(9, "a", None), (8, "b", 1.0)], schema)
    added = keyed.absent_rows(known, new, ["zone", "x"], [F.asc("id")])
    assert sorted(r.id for r in added.collect()) == [1, 2, 3]


@pytest.mark.parametrize("value, text", [(55.249, "55.2"), (849.496, "849.5"), (1.15, "1.2"), (1e30, "nan"), (float("nan"), "nan")])
def test_alert_texts_round_once(spark, frame, value, text):
    row = alerts.pm25_high_alerts(frame({"pm25": value + 0.0})).first() if value > 50 or value != value else None
    expected = f"PM2.5 level {text} μg/m³ exceeds safe threshold"
    if row is not None:
        assert row.message == expected
    shown = alerts.threshold_alerts(frame({"pm25": 1.0, "co2_ppm": 849.496})).first()
    assert shown.message == "CO₂ 849 ppm"


def test_an_error_without_text_is_reported(spark, frame, monkeypatch):
    from aerolens.plans import monitor

    def fails(*_):
        raise RuntimeError()

    store = Store(spark, scratch_path(spark, "store"), "day")
    write_partitioned(frame({}, {}), store.path("readings"))
    monkeypatch.setattr(monitor, "detect_step", fails)
    assert run_cycle(spark, store, cycle=1).errors == {"detect": "RuntimeError"}
