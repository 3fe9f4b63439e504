"""The monitoring cycle: detect, alert, train, score, report, retain."""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolens.operators.aggregates import cycle_metrics, recent_prediction_count
from aerolens.operators.alerts import ALERT_COLUMNS, anomaly_alerts, anomaly_alerts_simple
from aerolens.operators.derive import with_aqi_bucket, with_derived_features
from aerolens.operators.filters import quality_gate, training_gate
from aerolens.operators.forest import fit_isolation_forest, isolation_outliers
from aerolens.operators.keyed import absent_rows
from aerolens.operators.model import model_features, score_aqi, update_aqi_model
from aerolens.operators.outliers import zscore_outliers
from aerolens.operators.statistics import ONE_BRACKET_ROWS, exact_quantiles, imputed_moments, medians_of, settled
from aerolens.plans.deletes import finish_deletes
from aerolens.plans.store import Store
from aerolens.schema import DERIVED_FEATURES, FOREST_FEATURES, MONITOR_FEATURES, TRAINING_FEATURES
from aerolens.session import materialized, scratch_removed
from aerolens.sources.tables import append_batch, read_table, timestamp_literal

SOURCE = "monitor"
RECENT_MINUTES = 5
CYCLE_LOG = "run_id string, cycle bigint, outliers bigint, predictions bigint, seconds double"
COLUMNS = ["record_id", "station_id", "ts", "data_quality_score", *MONITOR_FEATURES]


@dataclass(frozen=True)
class Profile:
    """What a monitoring cycle looks at, and how much of it there must be."""

    name: str
    features: list[str]
    training: list[str]
    require: tuple[str, ...]
    trees: int
    max_samples: int
    min_detect: int
    min_train: int
    statistical: bool


# The full monitor, and the simpler one that uses the forest alone.
FULL = Profile(
    "monitor", MONITOR_FEATURES, MONITOR_FEATURES + DERIVED_FEATURES, ("pm25", "co2_ppm"), 200, 1000, 20, 30, True
)
SIMPLE = Profile("monitor-simple", FOREST_FEATURES, TRAINING_FEATURES, (), 100, 256, 10, 50, False)


@dataclass
class CycleReport:
    """What one cycle did; ``errors`` names the steps that failed."""

    cycle: int
    outliers: int = 0
    predictions: int = 0
    seconds: float = 0.0
    errors: dict[str, str] = field(default_factory=dict)


def detect_anomalies(
    window: DataFrame, profile: Profile = FULL, *, contamination: float = 0.05, trees: int | None = None,
    narrow: bool = True,
) -> DataFrame:
    """Rows of a gated window with the flags of the forest and, in the full profile, of the z-scores.

    The medians and moments are computed once for all steps. ``narrow`` as in ``exact_quantiles``.
    """
    features = profile.features
    moments = settled(imputed_moments(window, features, narrow))
    medians = medians_of(moments, features)
    nodes = fit_isolation_forest(
        window, features, trees=trees or profile.trees, max_samples=profile.max_samples, medians=medians
    )
    flagged = isolation_outliers(
        window, nodes, features, contamination=contamination, medians=medians, narrow=narrow
    )
    return zscore_outliers(flagged, features, moments=moments) if profile.statistical else flagged


def _alerts(flagged: DataFrame, profile: Profile) -> DataFrame:
    if profile.statistical:
        return anomaly_alerts(flagged)
    return anomaly_alerts_simple(flagged.withColumnRenamed("is_isolation_outlier", "is_outlier"))


def _narrow(stored: DataFrame) -> bool:
    """Whether a stored window is so large that its quantiles need a narrower bracket; only file footers are read."""
    return stored.count() > ONE_BRACKET_ROWS


def _has_rows(df: DataFrame, minimum: int) -> bool:
    return df.limit(minimum).count() >= minimum


def detect_step(
    store: Store, as_of: dt.datetime, cycle: int, minutes: int, profile: Profile = FULL,
    contamination: float = 0.05, trees: int | None = None,
) -> int:
    """Raise an alert for each anomaly that has none yet; returns how many were found."""
    window = quality_gate(store.readings(minutes, as_of, COLUMNS), require=profile.require)
    if not _has_rows(window, profile.min_detect):
        return 0
    # Several passes follow; the window is cut out of the large table once.
    window = materialized(window, "window")
    found = _alerts(detect_anomalies(
        window, profile, contamination=contamination, trees=trees, narrow=_narrow(window)
    ), profile)
    # An alert carries the time of its reading, so older ones need not be looked at. Rows that an
    # earlier try of this cycle wrote do not count as known: they are written again.
    known = store.alerts(as_of - dt.timedelta(minutes=minutes)).where(
        (F.col("source") != SOURCE) | (F.col("batch_id") != cycle)
    )
    fresh = absent_rows(known, found, ["record_id", "alert_type"], [F.desc("anomaly_score")])
    store.append_alerts(fresh.select(*ALERT_COLUMNS), SOURCE, cycle)
    return found.count()


def train_and_score_step(
    store: Store, as_of: dt.datetime, cycle: int, minutes: int, profile: Profile = FULL
) -> int:
    """Update the classifier on the window and upsert a prediction for each of its readings.

    Predictions come from the fully trained model that is chosen for this profile, see ``plans.training``, or from
    the updated state if none is. Returns the number of predictions made in the last minutes, by the ingest stream too.
    """
    scoring = quality_gate(store.readings(minutes, as_of, COLUMNS), require=profile.require)
    # Rows to train on are among the rows to score.
    scoring = materialized(with_derived_features(with_aqi_bucket(scoring)), "window")
    training = training_gate(scoring, require=profile.require)
    if not _has_rows(training, profile.min_train):
        return 0
    features = profile.training
    narrow = _narrow(scoring)
    medians = settled(exact_quantiles(training, features, narrow=narrow))
    # Each profile has its own features, and so its own model.
    state = update_aqi_model(training, features, store.model_before(profile.name, cycle), medians=medians)
    store.save_model(state, profile.name, cycle)
    judge, version = state, "v1.0"
    chosen = store.chosen_version(profile.name)
    if chosen is not None:
        judge, version = store.full_model_version(profile.name, chosen), f"full-{chosen}"
        features = model_features(judge)
    scored = score_aqi(
        scoring, judge,
        medians=settled(exact_quantiles(scoring, features, narrow=narrow)),
        version=version,
        predicted_at=timestamp_literal(as_of),
    )
    store.upsert_predictions(scored)
    made = store.predictions(as_of - dt.timedelta(minutes=minutes + RECENT_MINUTES))
    return recent_prediction_count(made, timestamp_literal(as_of), RECENT_MINUTES).first()[0]


def report_step(store: Store, as_of: dt.datetime, run_id: str, report: CycleReport) -> None:
    """Log the cycle, append its metrics with running totals, and keep the newest metrics."""
    spark = store.spark
    entry = spark.createDataFrame(
        [(run_id, report.cycle, report.outliers, report.predictions, report.seconds)], CYCLE_LOG
    )
    append_batch(entry.coalesce(1), store.path("cycle_log"), report.cycle)
    log = read_table(spark, store.path("cycle_log"), entry.schema, "batch_id bigint")
    metrics = cycle_metrics(log.where(F.col("run_id") == run_id)).where(F.col("cycle") == report.cycle)
    store.append_metrics(metrics.drop("run_id", "cycle"), SOURCE, report.cycle, timestamp_literal(as_of))
    store.retain_metrics()


def run_cycle(
    spark: SparkSession,
    store: Store,
    *,
    cycle: int,
    as_of: dt.datetime | None = None,
    run_id: str = "monitor",
    outlier_window: int = 60,
    ml_window: int = 120,
    profile: Profile = FULL,
    contamination: float = 0.05,
    trees: int | None = None,
) -> CycleReport:
    """One monitoring cycle. A failing step is reported and does not stop the others.

    ``cycle`` is the batch id of everything the cycle writes, so a cycle can be run again. Have a
    scheduler of your choice call this every so often with rising numbers.
    """
    begun = time.monotonic()
    report = CycleReport(cycle)
    finish_deletes(store)
    as_of = as_of or store.latest()
    if as_of is None:
        return report

    def step(name: str, action) -> int:
        try:
            return action() or 0
        except Exception as error:  # a cycle goes on whatever one step runs into
            report.errors[name] = (str(error).splitlines() or [type(error).__name__])[0]
            return 0

    with scratch_removed(spark):
        report.outliers = step(
            "detect", lambda: detect_step(store, as_of, cycle, outlier_window, profile, contamination, trees)
        )
        report.predictions = step("score", lambda: train_and_score_step(store, as_of, cycle, ml_window, profile))
        report.seconds = time.monotonic() - begun
        step("report", lambda: report_step(store, as_of, run_id, report))
    return report
