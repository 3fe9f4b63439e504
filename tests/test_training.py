"""Full training as a job, the choice between versions, and what a cycle scores with."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from aerolens.operators import derive, filters, model
from aerolens.plans.monitor import COLUMNS, FULL, run_cycle
from aerolens.plans.store import Store
from aerolens.plans.training import roll_back, train_full_model
from aerolens.session import scratch_path
from aerolens.sources.tables import write_partitioned

WEEK = 7 * 24 * 60
LONG = 60 * WEEK


@pytest.fixture(scope="module")
def trained(spark):
    """A poor model, a better one, a poor one again."""
    from aerolens.sources.testviews import TestTables
    from tests.conftest import DATA

    readings = TestTables(spark, str(DATA / "sf0.001")).readings
    store = Store(spark, scratch_path(spark, "training"), "day")
    write_partitioned(readings, store.path("readings"))
    assert store.chosen_version(FULL.name) is None
    entries = [
        train_full_model(spark, store, version=v, minutes=LONG, max_iter=n) for v, n in ((1, 2), (2, 25), (3, 1))
    ]
    return readings, store, entries


def rows_to_train(readings):
    return filters.training_gate(derive.with_derived_features(derive.with_aqi_bucket(readings.select(*COLUMNS))))


def test_a_worse_model_is_not_taken(trained):
    _, store, (poor, better, again) = trained
    assert [e["action"] for e in (poor, better, again)] == ["taken", "taken", "left"]
    assert better["log_loss"] < poor["log_loss"] and again["log_loss"] > again["rival_log_loss"]
    assert again["rival_log_loss"] == pytest.approx(better["log_loss"])
    assert [e["chosen"] for e in (poor, better, again)] == [1, 2, 2]
    assert store.chosen_version(FULL.name) == 2
    assert store.model_registry().count() == 3


def test_figures_are_those_of_the_held_out_rows(trained):
    readings, store, (_, better, _) = trained
    rows = rows_to_train(readings)
    ids = [r.record_id for r in rows.select("record_id").collect()]
    held = {i for i in ids if hashlib.md5(str(i).encode()).hexdigest()[0] in "012"}
    assert (better["train_rows"], better["held_out_rows"]) == (len(ids) - len(held), len(held))
    scored = model.score_aqi(
        rows.where(F.col("record_id").isin(list(held))), store.full_model_version(FULL.name, 2), keep=("aqi_bucket",)
    ).collect()
    losses = [-math.log(max(r[f"proba_{r.aqi_bucket.lower()}"], 1e-15)) for r in scored]
    assert better["log_loss"] == pytest.approx(sum(losses) / len(losses))
    assert better["correct"] == sum(r.aqi_pred == r.aqi_bucket for r in scored)


def test_held_out_figures_of_nothing_and_unlabelled(spark):
    columns = "aqi_pred string, aqi_bucket string, " + ", ".join(f"{p} double" for p in model.PROBABILITIES)
    rows = [("Good", "Good", 0.5, 0.5, 0.0, 0.0), ("Good", None, 1.0, 0.0, 0.0, 0.0), ("Good", "Hazardous", 1.0, 0.0, 0.0, 0.0)]
    found = model.held_out_figures(spark.createDataFrame(rows, columns)).first()
    assert (found.rows, found.correct) == (2, 1)
    assert found.log_loss == pytest.approx((math.log(2) - math.log(1e-15)) / 2)
    assert tuple(model.held_out_figures(spark.createDataFrame([], columns)).first()) == (0, 0, None)


def scored_with(store):
    return {r.model_version for r in store.predictions().select("model_version").distinct().collect()}


def test_a_cycle_scores_with_the_chosen_model(spark, trained):
    readings, store, _ = trained
    as_of = store.latest()
    report = run_cycle(spark, store, cycle=1, as_of=as_of, outlier_window=60, ml_window=WEEK)
    assert report.errors == {} and scored_with(store) == {"full-2"}
    window = filters.quality_gate(store.readings(WEEK, as_of, COLUMNS), require=FULL.require)
    expected = model.score_aqi(derive.with_derived_features(window), store.full_model_version(FULL.name, 2))
    both = store.predictions().alias("a").join(expected.alias("b"), "record_id")
    assert both.count() == expected.count() == store.predictions().count() > 0
    assert both.where("a.aqi_pred <> b.aqi_pred or abs(a.confidence_score - b.confidence_score) > 1e-6").count() == 0

    roll_back(store, 1, version=4, as_of=as_of)
    assert store.chosen_version(FULL.name) == 1
    report = run_cycle(spark, store, cycle=2, as_of=as_of, outlier_window=60, ml_window=WEEK)
    assert report.errors == {} and scored_with(store) == {"full-1"}
    with pytest.raises(ValueError):
        roll_back(store, 99, version=5, as_of=as_of)
    with pytest.raises(ValueError):
        roll_back(store, 1, version=2, as_of=as_of)


def test_a_run_lost_before_its_entry_changes_nothing(spark, trained, monkeypatch):
    _, store, _ = trained
    before = store.chosen_version(FULL.name)

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Store, "register_model", fails)
        with pytest.raises(RuntimeError):
            train_full_model(spark, store, version=9, minutes=LONG)
    assert store.chosen_version(FULL.name) == before
    entry = train_full_model(spark, store, version=9, minutes=LONG)
    assert entry["rival"] == before and store.chosen_version(FULL.name) == entry["chosen"]
    # A version that is in use and trained again does not compete with itself.
    again = train_full_model(spark, store, version=9, minutes=LONG)
    assert again["rival"] == before and again["log_loss"] == pytest.approx(entry["log_loss"])


def test_too_few_rows_leave_no_entry(spark, small):
    store = Store(spark, scratch_path(spark, "untrained"), "day")
    assert train_full_model(spark, store, version=1, minutes=LONG) is None
    write_partitioned(small.readings.where("record_id < 20"), store.path("readings"))
    assert train_full_model(spark, store, version=1, minutes=LONG) is None
    assert store.chosen_version(FULL.name) is None and store.model_registry().count() == 0
