"""The sample and the forests that the ingest stream keeps by itself."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from aerolens.operators.alerts import ALERT_COLUMNS, batch_outlier_alerts
from aerolens.operators.forest import fit_isolation_forest
from aerolens.operators.reservoir import merged_sample
from aerolens.plans.store import Store
from aerolens.session import scratch_path
from aerolens.streaming.ingest import KeptForests, detect_batch, process_batch, stored_baseline

SCHEMA = "record_id bigint, ts timestamp, pm25 double, co2_ppm double, extra string"
KEY, VALUES = ["record_id", "ts"], ["pm25", "co2_ppm"]
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def made(n):
    return [(i, START + dt.timedelta(seconds=i), float(i % 7), None if i % 5 == 0 else float(i), "x") for i in range(n)]


def lowest(rows, size, seed=42):
    """Bottom-k by hand, one row a key."""
    def place(row):
        micros = "" if row[1] is None else str(int(row[1].timestamp()) * 1_000_000)
        return hashlib.md5(f"{seed}:{'' if row[0] is None else row[0]}:{micros}".encode()).hexdigest()

    return sorted({(place(r), r[0]) for r in rows})[:size]


def places(sample):
    return sorted((r.place, r.record_id) for r in sample.collect())


def taken(spark, batches, size):
    sample = None
    for batch in batches:
        sample = merged_sample(sample, spark.createDataFrame(batch, SCHEMA), KEY, VALUES, size=size)
    return sample


@pytest.mark.parametrize("cuts", [[0, 500], [0, 3, 4, 260, 500], [0, 0, 499, 500]])
def test_sample_is_the_lowest_places_however_the_rows_are_cut(spark, cuts):
    rows = made(500)
    batches = [rows[low:high] for low, high in zip(cuts, cuts[1:])]
    assert places(taken(spark, batches, 40)) == lowest(rows, 40)
    assert places(taken(spark, batches, 1000)) == lowest(rows, 1000)


def test_repeated_rows_nulls_and_nothing(spark):
    rows = made(60)
    odd = [(None, START, 1.0, 1.0, "x"), (None, None, 2.0, 2.0, "x"), (3, None, None, None, None)]
    sample = taken(spark, [rows * 3 + odd, rows[:20], []], 50)
    assert places(sample) == sorted(lowest(rows + odd, 50), key=lambda p: (p[0], p[1] or 0))
    # Rows of one key with other values are one row, of the least values.
    twice = taken(spark, [[(1, START, 5.0, 1.0, "a"), (1, START, 4.0, 9.0, "b")]], 10).collect()
    assert [(r.pm25, r.co2_ppm) for r in twice] == [(4.0, 9.0)]
    assert taken(spark, [[], []], 10).count() == 0


KEPT = KeptForests(sample_rows=200, min_rows=150, refit_batches=2, trees=10, max_samples=64)


@pytest.fixture(scope="module")
def kept(spark):
    from aerolens.sources.testviews import TestTables
    from tests.conftest import DATA

    readings = TestTables(spark, str(DATA / "sf0.001")).readings
    store = Store(spark, scratch_path(spark, "kept"), "day")
    parts = [readings.where(f"record_id % 5 = {k}") for k in range(5)]
    for batch_id, part in enumerate(parts):
        process_batch(store, part, batch_id, baseline=KEPT)
    return readings, store, parts


def versions(store, name):
    found = {r.batch_id for r in store.spark.read.parquet(store.path(name, "ingest")).select("batch_id").distinct().collect()}
    return sorted(found)


def test_forests_are_renewed_by_age(kept):
    _, store, _ = kept
    assert versions(store, "sample") == [0, 1, 2, 3, 4]
    assert versions(store, "forests") == [0, 2, 4]
    assert stored_baseline(store, 0) is None
    assert [store.forests_before("ingest", n)[0] for n in range(1, 6)] == [0, 0, 2, 2, 4]


def rows_of(df):
    """Rows with numbers as far as the order of adding up leaves them."""
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_batches_are_judged_by_the_newest_forests_before_them(spark, kept):
    readings, store, parts = kept
    # What the stream should have used for batch 3: forests on the sample of the batches 0 to 2.
    sample = merged_sample(None, readings.where("record_id % 5 < 3"), KEY, VALUES, size=KEPT.sample_rows)
    assert places(sample) == places(store.sample_before("ingest", 3))
    baseline = tuple(
        fit_isolation_forest(sample, [c], trees=KEPT.trees, max_samples=KEPT.max_samples, key="place") for c in VALUES
    )
    flagged = detect_batch(parts[3], parts[3].count(), baseline)
    expected = batch_outlier_alerts(flagged).select(*ALERT_COLUMNS)
    columns = ["record_id", "alert_type", "message", "anomaly_score"]
    got = store.alerts().where("batch_id = 3 and alert_type = 'Outlier Detected'")
    assert got.count() > 0
    assert rows_of(got.select(*columns)) == rows_of(expected.select(*columns))
    # The first batch had none and was judged by z-scores.
    first = batch_outlier_alerts(detect_batch(parts[0], parts[0].count())).select(*columns)
    assert rows_of(store.alerts().where("batch_id = 0 and alert_type = 'Outlier Detected'").select(*columns)) == rows_of(first)


def test_a_repeated_batch_writes_the_same(spark, kept):
    _, store, parts = kept

    def state():
        forests = spark.read.parquet(store.path("forests", "ingest"))
        return (
            rows_of(store.sample_before("ingest", 9)), rows_of(forests),
            rows_of(store.alerts().drop("created_at")),
        )

    before = state()
    process_batch(store, parts[4], 4, baseline=KEPT)
    assert state() == before


def test_no_forests_before_there_are_enough_rows(spark, small):
    store = Store(spark, scratch_path(spark, "few"), "day")
    process_batch(store, small.readings.where("record_id < 100"), 0, baseline=KEPT)
    assert store.forests_before("ingest", 5) == (None, None)
    assert store.sample_before("ingest", 1).count() == 100
