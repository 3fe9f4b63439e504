"""The zone stream: late, repeated and lost batches, zones without a name, compaction."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerolens.operators.series import zone_windows
from aerolens.plans.store import Store
from aerolens.session import scratch_path
from aerolens.streaming.zones import process_zone_batch

START = dt.datetime(2024, 1, 1, 23, 30)
STATIONS = [(1, "north"), (2, "south"), (3, None)]


def rows(df):
    return sorted(map(tuple, df.select("window_start", "window_end", "city_zone", "readings", F.round("avg_pm25", 6), "max_pm25").collect()), key=repr)


def batch(spark, *readings):
    """Readings as (station, minutes from the start, pm25)."""
    given = [(s, None if m is None else START + dt.timedelta(minutes=m), p) for s, m, p in readings]
    return spark.createDataFrame(given, "station_id bigint, ts timestamp, pm25 double")


@pytest.fixture
def store(spark):
    made = Store(spark, scratch_path(spark, "zones"))
    table = spark.createDataFrame(STATIONS, "station_id bigint, city_zone string").withColumn("batch_id", F.lit(0))
    table.write.partitionBy("batch_id").parquet(made.path("stations"))
    return made


def over_all(spark, store, *batches):
    whole = batches[0]
    for other in batches[1:]:
        whole = whole.unionByName(other)
    located = whole.where("ts is not null").join(store.stations().select("station_id", "city_zone"), "station_id")
    return zone_windows(located)


def test_late_readings_correct_stored_windows(spark, store):
    """Windows over midnight, a null zone and a null value; a station that is not known and a null time are left out."""
    parts = [
        batch(spark, (1, 0, 10.0), (1, 0.5, 20.0), (2, 40, None), (3, 10, 5.0), (9, 1, 99.0), (1, None, 7.0)),
        batch(spark, (1, 3000, 1.0)),
        batch(spark, (1, 29, 40.0), (1, 31, 50.0), (3, 10, 7.0), (2, 2999, 4.0), (2, 2997, 6.0)),
        batch(spark),
        batch(spark, (2, 2999, 8.0)),
    ]
    for number, part in enumerate(parts):
        process_zone_batch(store, part, number)
        assert rows(store.zone_windows()) == rows(over_all(spark, store, *parts[: number + 1]))
    logged = {r["batch_id"]: (r["arrived"], r["late"]) for r in store.zone_log().collect()}
    # Of the third batch only the reading one minute behind is not late.
    assert logged == {0: (5, 0), 1: (1, 0), 2: (5, 4), 3: (0, 0), 4: (1, 0)}


@pytest.mark.parametrize("step", ["append_zone_steps", "upsert_zone_windows", "append_zone_log"])
@pytest.mark.parametrize("after", [False, True])
def test_batch_lost_at_a_step_is_made_good(spark, store, monkeypatch, step, after):
    first, second = batch(spark, (1, 0, 10.0), (2, 5, 3.0)), batch(spark, (1, 1, 20.0), (1, 2, 30.0))
    process_zone_batch(store, first, 0)
    whole = getattr(Store, step)

    def lost(self, *args, **kwargs):
        if after:
            whole(self, *args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(Store, step, lost)
    with pytest.raises(RuntimeError):
        process_zone_batch(store, second, 1)
    monkeypatch.undo()
    process_zone_batch(store, second, 1)
    assert rows(store.zone_windows()) == rows(over_all(spark, store, first, second))
    assert sorted((r["batch_id"], r["arrived"]) for r in store.zone_log().collect()) == [(0, 2), (1, 2)]


def test_steps_put_together_give_the_same_windows(spark, store):
    parts = [batch(spark, (1, 7 * i % 90, float(i)), (2, 3 * i, float(i))) for i in range(7)]
    for number, part in enumerate(parts):
        process_zone_batch(store, part, number)
        if number and number % 2 == 0:
            store.compact_zone_steps(number, fan=2, grace=0)
    assert rows(store.zone_windows()) == rows(over_all(spark, store, *parts))


def test_only_touched_days_are_written(spark, store):
    process_zone_batch(store, batch(spark, (1, 0, 1.0), (1, 4320, 2.0)), 0)
    before = {f: (f.stat().st_mtime_ns) for f in _files(store)}
    process_zone_batch(store, batch(spark, (1, 4321, 3.0)), 1)
    kept = {f for f in _files(store) if f in before}
    assert any("ts_day=20240101" in str(f) for f in kept) and not any("ts_day=20240104" in str(f) for f in kept)


def _files(store):
    from pathlib import Path

    return [f for f in Path(store.path("zone_windows")).rglob("*.parquet") if "_staged" not in str(f)]


def test_windows_need_whole_slides(spark, store):
    with pytest.raises(ValueError):
        process_zone_batch(store, batch(spark), 0, minutes=10, slide_minutes=3)
