"""Isolation forest and classifier: properties instead of equal values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Observation, functions as F

from aerolens.operators import derive, filters, forest, model
from aerolens.operators.aggregates import model_accuracy
from aerolens.schema import AQI_LABELS, STREAM_FEATURES


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"record_id": range(3000), "a": rng.normal(size=3000), "b": rng.normal(size=3000)})
    pdf.loc[:9, "a"] = 12.0 + pdf.loc[:9, "a"]  # ten planted extremes
    return spark.createDataFrame(pdf)


@pytest.fixture(scope="module")
def nodes(cloud):
    return forest.fit_isolation_forest(cloud, ["a", "b"], trees=50, max_samples=128).cache()


def test_trees_are_whole(nodes):
    table = nodes.toPandas()
    assert sorted(table["tree_id"].unique()) == list(range(50))
    assert set(table["sample_size"]) == {128}
    for _, tree in table.groupby("tree_id"):
        inner = tree[tree["feature"] >= 0]
        children = set(inner["left"]) | set(inner["right"])
        assert children == set(tree["node_id"]) - {0}
        assert len(tree) == 2 * len(inner) + 1


def test_forest_does_not_depend_on_partitioning(cloud, nodes):
    again = forest.fit_isolation_forest(cloud.repartition(13), ["a", "b"], trees=50, max_samples=128)
    key = ["tree_id", "node_id"]
    left, right = (df.toPandas().sort_values(key, ignore_index=True) for df in (nodes, again))
    pd.testing.assert_frame_equal(left, right)


def test_planted_extremes_are_flagged(cloud, nodes):
    flagged = forest.isolation_outliers(cloud, nodes, ["a", "b"], contamination=0.05)
    rows = flagged.where("is_isolation_outlier").collect()
    assert abs(len(rows) - 150) <= 1
    assert set(range(10)) <= {r.record_id for r in rows}
    span = flagged.agg(F.min("isolation_score"), F.max("isolation_score")).first()
    assert 0 < span[0] < span[1] < 1


def test_scores_match_a_plain_walk(cloud, nodes):
    table = nodes.toPandas().set_index(["tree_id", "node_id"])
    row = cloud.where("record_id = 3").first()
    lengths = []
    for tree in range(50):
        node = 0
        while table.loc[(tree, node), "feature"] >= 0:
            step = table.loc[(tree, node)]
            side = "left" if row[1 + int(step["feature"])] <= step["threshold"] else "right"
            node = int(step[side])
        lengths.append(table.loc[(tree, node), "path"])
    expected = 2 ** (-np.mean(lengths) / forest.average_path(128))
    got = forest.score_isolation_forest(cloud.where("record_id = 3"), nodes, ["a", "b"]).first()
    assert got["isolation_score"] == pytest.approx(expected)


def test_copies_of_one_key_do_not_fill_the_sample(cloud):
    hot = cloud.where("record_id = 5").select(F.explode(F.sequence(F.lit(1), F.lit(2000))).alias("_"), "*").drop("_")
    sample = forest.sample_per_tree(cloud.unionByName(hot), "record_id", ["a"], 20, 64, 1)
    assert sample.groupBy("tree_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] < 200
    assert sample.where("tree_id = 0").groupBy("place").count().agg(F.max("count")).first()[0] == 1


def test_missing_values_and_constant_features(spark):
    df = spark.sql("select id as record_id, 1D as a, if(id % 3 = 0, null, cast(id as double)) as b from range(60)")
    grown = forest.fit_isolation_forest(df, ["a", "b"], trees=5, max_samples=32)
    scored = forest.score_isolation_forest(df, grown, ["a", "b"])
    assert scored.where("isolation_score is null").count() == 0
    assert grown.where("feature = 0").count() == 0


@pytest.fixture(scope="module")
def training(spark):
    from aerolens.sources.testviews import TestTables
    from tests.conftest import DATA

    tables = TestTables(spark, str(DATA / "sf0.01"))
    return filters.training_gate(derive.with_aqi_bucket(tables.readings)).cache()


def accuracy(training, scored):
    both = scored.join(training.select("record_id", "aqi_bucket"), "record_id")
    return model_accuracy(both, "aqi_pred", "aqi_bucket").first()[0]


def check_probabilities(scored):
    total = F.expr("abs(proba_good + proba_moderate + proba_unhealthy + proba_hazardous - 1)")
    assert scored.agg(F.max(total)).first()[0] < 1e-9
    assert scored.where("confidence_score <> greatest(proba_good, proba_moderate, proba_unhealthy, proba_hazardous)").count() == 0
    assert scored.where(~F.col("aqi_pred").isin(AQI_LABELS)).count() == 0


def test_full_training(training):
    trained = model.train_aqi_model(training)
    scored = model.score_aqi(training, trained)
    check_probabilities(scored)
    assert accuracy(training, scored) > 0.85
    assert model.model_features(trained) == STREAM_FEATURES


def test_incremental_training_improves(training):
    first = model.update_aqi_model(training)
    state = first
    for _ in range(4):
        state = model.update_aqi_model(training, state=state)
    scored = model.score_aqi(training, state)
    check_probabilities(scored)
    assert accuracy(training, scored) >= 0.6
    rows = {r.feature: r for r in state.collect()}
    assert rows["pm25"].n == 5 * training.count()
    assert rows["pm25"].mean == pytest.approx(training.agg(F.avg("pm25")).first()[0])
    spread = (rows["pm25"].m2 / rows["pm25"].n) ** 0.5
    assert spread == pytest.approx(training.agg(F.stddev_pop("pm25")).first()[0])


def test_no_labels_leave_the_state(training):
    state = model.update_aqi_model(training)
    assert model.update_aqi_model(training.where("false"), state=state) is state
    assert model.train_aqi_model(training.where("false")) is None


def test_full_model_is_saved_and_loaded(spark, small):
    from aerolens.operators import filters
    from aerolens.operators.derive import with_aqi_bucket
    from aerolens.plans.store import Store
    from aerolens.session import scratch_path

    training = filters.training_gate(with_aqi_bucket(small.readings))
    store = Store(spark, scratch_path(spark, "models"))
    assert store.full_model("aqi") is None
    store.save_full_model(model.train_aqi_model(training, max_iter=1), "aqi", 1)
    newest = model.train_aqi_model(training)
    store.save_full_model(newest, "aqi", 2)
    store.save_full_model(newest, "aqi", 2)  # again, as after a failure
    loaded = store.full_model("aqi")
    assert model.model_features(loaded) == model.model_features(newest)
    chances = ["record_id", "aqi_pred", "confidence_score"]
    assert model.score_aqi(training, loaded).select(*chances).exceptAll(
        model.score_aqi(training, newest).select(*chances)
    ).count() == 0
    assert model.update_aqi_model(training.where("false")).count() == 0


def test_other_features_are_refused(training):
    state = model.update_aqi_model(training, ["pm25", "humidity"])
    with pytest.raises(ValueError):
        model.update_aqi_model(training, ["pm25"], state)


def test_untrained_is_even(training):
    row = model.score_aqi(training, None).first()
    assert (row.aqi_pred, row.proba_hazardous, row.confidence_score) == ("Good", 0.25, 0.25)


def test_class_that_never_occurs_gets_zero(training):
    trained = model.train_aqi_model(training.where("aqi_bucket in ('Good', 'Moderate')"))
    assert model.score_aqi(training, trained).agg(F.max("proba_hazardous")).first()[0] == 0.0


def test_two_classes_are_scored_after_an_observation(spark, training):
    seen = Observation()
    assert spark.range(3).observe(seen, F.count("*").alias("n")).count() and seen.get["n"] == 3
    trained = model.train_aqi_model(training.where("aqi_bucket in ('Good', 'Moderate')"))
    assert not trained.stages[-1].hasSummary
    assert model.score_aqi(training, trained).agg(F.max("proba_hazardous")).first()[0] == 0.0


def test_one_epoch_over_one_partition_equals_numpy(spark):
    """Moments, scaling and every mini-batch step of one class a column, by hand."""
    rng = np.random.default_rng(11)
    values, labels = rng.normal(50, 20, (101, 2)), rng.integers(0, len(AQI_LABELS), 101)
    rows = [(float(a), float(b), AQI_LABELS[k]) for (a, b), k in zip(values, labels)]
    training = spark.createDataFrame(rows, "humidity double, pm25 double, aqi_bucket string").coalesce(1)
    x = np.column_stack([(values - values.mean(0)) / values.std(0), np.ones(len(values))])
    y, weights, state = np.eye(len(AQI_LABELS))[labels], np.zeros((3, len(AQI_LABELS))), None
    for _ in range(2):
        state = model.update_aqi_model(training, ["humidity", "pm25"], state, learning_rate=0.3, batch_rows=16)
        for start in range(0, len(x), 16):
            part = x[start : start + 16]
            error = 1 / (1 + np.exp(-part @ weights)) - y[start : start + 16]
            weights = weights - 0.3 * part.T @ error / len(part)
        found = {row["feature"]: [row[w] for w in model.WEIGHTS] for row in state.collect()}
        np.testing.assert_allclose([found[c] for c in ("humidity", "pm25", model.BIAS)], weights, rtol=0, atol=1e-9)
