"""AQI classifier: full training with MLlib, incremental updates, scoring.

The label is a step function of PM2.5, and PM2.5 is one of the features, so a high accuracy is
expected and says little about forecasting.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from aerolens.functions.ladders import label_index
from aerolens.operators.statistics import exact_quantiles, settled, with_scalar
from aerolens.schema import AQI_LABELS, STREAM_FEATURES

PROBABILITIES = [f"proba_{name.lower()}" for name in AQI_LABELS]
WEIGHTS = [f"weight_{name.lower()}" for name in AQI_LABELS]
BIAS = "(bias)"

# One row per feature and one for the bias: running moments, and a weight for every class.
STATE = "feature string, n double, mean double, m2 double, " + ", ".join(f"{w} double" for w in WEIGHTS)


def _prefixed(df: DataFrame, features: list[str], medians: DataFrame | None) -> DataFrame:
    """Add ``x_<feature>``: the value, or the frame's median where it is missing."""
    medians = settled(exact_quantiles(df, features)) if medians is None else medians.select(*features)
    return with_scalar(df, medians, "_m").withColumns(
        {f"x_{c}": F.expr(f"coalesce(cast({c} as double), _m.{c}, 0.0D)") for c in features}
    ).drop("_m")


def train_aqi_model(
    training: DataFrame,
    features: list[str] = STREAM_FEATURES,
    *,
    label: str = "aqi_bucket",
    medians: DataFrame | None = None,
    max_iter: int = 25,
) -> PipelineModel | None:
    """Fit a scaled multinomial logistic regression; ``None`` when no row has a label.

    The assembled inputs are named after the features, so the feature list is stored with the model.
    """
    labelled = training.where(F.col(label).isin(AQI_LABELS))
    if labelled.isEmpty():
        return None
    prepared = _prefixed(labelled, features, medians).selectExpr(
        *[f"x_{c}" for c in features], f"{label_index(label)} as label"
    )
    pipeline = Pipeline(
        stages=[
            VectorAssembler(inputCols=[f"x_{c}" for c in features], outputCol="assembled"),
            StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True),
            LogisticRegression(family="multinomial", maxIter=max_iter, regParam=1e-4),
        ]
    )
    model = pipeline.fit(prepared)
    # The summary of two classes holds the session, which tasks cannot take along once it has observed a query.
    model.stages[-1]._java_obj.setSummary(prepared.sparkSession._jvm.scala.Option.empty())
    return model


def save_aqi_model(model: PipelineModel, path: str) -> None:
    """Store a fully trained model, with its features, in place of an older one."""
    model.write().overwrite().save(path)


def load_aqi_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_features(model: PipelineModel | DataFrame) -> list[str]:
    """The features a model was trained on, in order."""
    if isinstance(model, DataFrame):
        return [row["feature"] for row in _state_rows(model) if row["feature"] != BIAS]
    return [c.removeprefix("x_") for c in model.stages[0].getInputCols()]


def _state_rows(state: DataFrame) -> list:
    """All rows of a model state: one per feature, checked to be few."""
    rows = state.limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("not a model state: too many rows")
    return sorted(rows, key=lambda row: (row["feature"] == BIAS, row["feature"]))


def _merged_moments(rows: list, batch, features: list[str]) -> dict[str, tuple[float, float, float]]:
    """Running count, mean and squared deviation after adding a batch."""
    known = {row["feature"]: (row["n"], row["mean"], row["m2"]) for row in rows}
    merged = {}
    for c in features:
        n, mean, m2 = known.get(c, (0.0, 0.0, 0.0))
        added, added_mean, added_m2 = float(batch["rows"]), batch[f"{c}_mean"], batch[f"{c}_var"] * batch["rows"]
        total, gap = n + added, added_mean - mean
        merged[c] = (total, mean + gap * added / total, m2 + added_m2 + gap * gap * n * added / total)
    return merged


def update_aqi_model(
    training: DataFrame,
    features: list[str] = STREAM_FEATURES,
    state: DataFrame | None = None,
    *,
    label: str = "aqi_bucket",
    medians: DataFrame | None = None,
    learning_rate: float = 0.1,
    batch_rows: int = 32,
) -> DataFrame:
    """One incremental step: a local epoch of SGD per partition, then the weighted mean of the weights.

    Parallelised SGD after Zinkevich, Weimer, Li and Smola (2010), with one logistic loss per class.
    Returns the new state, a frame of one row per feature; without labelled rows the state is unchanged.
    """
    spark = training.sparkSession
    features = sorted(features)
    labelled = training.where(F.col(label).isin(AQI_LABELS))
    prepared = _prefixed(labelled, features, medians)
    batch = prepared.agg(
        F.expr("count(*) as rows"),
        *[F.expr(f"avg(x_{c}) as {c}_mean") for c in features],
        *[F.expr(f"var_pop(x_{c}) as {c}_var") for c in features],
    ).first()
    rows = _state_rows(state) if state is not None else []
    if rows and [r["feature"] for r in rows] != [*features, BIAS]:
        raise ValueError("the state was trained on other features")
    if not batch["rows"]:
        return state if state is not None else spark.createDataFrame([], STATE)

    moments = _merged_moments(rows, batch, features)
    means = np.array([moments[c][1] for c in features])
    spread = np.array([math.sqrt(moments[c][2] / moments[c][0]) or 1.0 for c in features])
    weights = (
        np.array([[row[w] for w in WEIGHTS] for row in rows])
        if rows else np.zeros((len(features) + 1, len(AQI_LABELS)))
    )
    classes = len(AQI_LABELS)

    def local_epoch(batches):
        local, seen = weights.copy(), 0
        for frame in batches:
            data = frame.to_numpy(dtype=float)
            inputs = np.column_stack([(data[:, :-1] - means) / spread, np.ones(len(data))])
            targets = np.eye(classes)[data[:, -1].astype(int)]
            for start in range(0, len(data), batch_rows):
                x, y = inputs[start : start + batch_rows], targets[start : start + batch_rows]
                chance = 1.0 / (1.0 + np.exp(-np.clip(x @ local, -30, 30)))
                local -= learning_rate * x.T @ (chance - y) / len(x)
            seen += len(data)
        if seen:
            yield pd.DataFrame(
                {"position": range(len(local)), "rows": float(seen)}
                | {w: local[:, k] for k, w in enumerate(WEIGHTS)}
            )

    partials = prepared.selectExpr(
        *[f"x_{c}" for c in features], f"{label_index(label)} as label"
    ).mapInPandas(local_epoch, "position int, rows double, " + ", ".join(f"{w} double" for w in WEIGHTS))
    averaged = partials.groupBy("position").agg(
        *[F.expr(f"sum({w} * rows) / sum(rows) as {w}") for w in WEIGHTS]
    )
    moments[BIAS] = (float(batch["rows"]) + (rows[-1]["n"] if rows else 0.0), 0.0, 0.0)
    names = [*features, BIAS]
    averaged_rows = averaged.collect()  # one per feature
    return spark.createDataFrame(
        [(names[row["position"]], *moments[names[row["position"]]], *[row[w] for w in WEIGHTS]) for row in averaged_rows],
        STATE,
    )


def held_out_figures(scored: DataFrame, label: str = "aqi_bucket") -> DataFrame:
    """One row about scored rows that keep their true ``label``: how many, how many right, and the mean log loss.

    Rows without a label do not count; without any the loss is null. A chance counts as 1e-15 at least.
    """
    chance = f"case {label} " + " ".join(f"when '{n}' then {p}" for n, p in zip(AQI_LABELS, PROBABILITIES)) + " end"
    return scored.where(F.col(label).isin(AQI_LABELS)).agg(
        F.expr("count(*) as rows"),
        F.expr(f"count_if(aqi_pred = {label}) as correct"),
        F.expr(f"avg(-ln(greatest({chance}, 1e-15D))) as log_loss"),
    )


def _state_chances(state: DataFrame, features: list[str]) -> str:
    """Class chances as plain arithmetic, with the few weights as literals."""
    rows = {row["feature"]: row for row in _state_rows(state)}

    def chance(weight: str) -> str:
        terms = [repr(rows[BIAS][weight]) + "D"]
        for c in features:
            row = rows[c]
            factor = row[weight] / (math.sqrt(row["m2"] / row["n"]) or 1.0)
            terms.append(f"(x_{c} - ({row['mean']!r}D)) * ({factor!r}D)")
        return f"1 / (1 + exp(-greatest(-30D, least(30D, {' + '.join(terms)}))))"

    return f"array({', '.join(map(chance, WEIGHTS))})"


def score_aqi(
    df: DataFrame,
    model: PipelineModel | DataFrame | None,
    *,
    medians: DataFrame | None = None,
    version: str = "v1.0",
    predicted_at: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Label, class probabilities and confidence of every row, with the columns to ``keep``.

    ``model`` is an MLlib model, a state of ``update_aqi_model`` or ``None``, which gives every
    class the same probability.
    """
    if model is None or (isinstance(model, DataFrame) and model.isEmpty()):
        even = ", ".join([f"{1.0 / len(AQI_LABELS)}D"] * len(AQI_LABELS))
        scored = df.withColumn("_p", F.expr(f"array({even})"))
    elif isinstance(model, DataFrame):
        features = model_features(model)
        scored = (
            _prefixed(df, features, medians)
            .withColumn("_c", F.expr(_state_chances(model, features)))
            .withColumn("_t", F.expr(" + ".join(f"_c[{i}]" for i in range(len(AQI_LABELS)))))
            .withColumn("_p", F.expr(f"array({', '.join(f'_c[{i}] / _t' for i in range(len(AQI_LABELS)))})"))
        )
    else:
        prepared = _prefixed(df, model_features(model), medians)
        scored = model.transform(prepared).withColumn("_p", vector_to_array("probability"))
    labels = ", ".join(f"'{name}'" for name in AQI_LABELS)
    return scored.withColumn("predicted_at", F.col("ts") if predicted_at is None else predicted_at).selectExpr(
        "record_id",
        "station_id",
        f"element_at(array({labels}), cast(array_position(_p, array_max(_p)) as int)) as aqi_pred",
        # The last classes have no entry when training saw none of them.
        *[f"coalesce(get(_p, {i}), 0.0D) as {name}" for i, name in enumerate(PROBABILITIES)],
        "array_max(_p) as confidence_score",
        f"'{version}' as model_version",
        "predicted_at",
        "ts",
        *keep,
    )
