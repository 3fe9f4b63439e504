"""The ingest stream: append, detect, alert, learn, score and report per micro-batch."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolens.operators.aggregates import batch_metrics, metric_rows
from aerolens.operators.alerts import ALERT_COLUMNS, batch_outlier_alerts, threshold_alerts
from aerolens.operators.derive import with_aqi_bucket
from aerolens.operators.forest import fit_isolation_forest, stream_forest_scores
from aerolens.operators.keyed import first_per_key
from aerolens.operators.model import score_aqi, update_aqi_model
from aerolens.operators.outliers import percentile_outliers, zsum_outliers
from aerolens.operators.quality import as_declared, checked_readings, quarantine_rows
from aerolens.operators.reservoir import PLACE, merged_sample
from aerolens.operators.statistics import exact_quantiles, settled
from aerolens.plans.deletes import finish_deletes
from aerolens.plans.store import Store
from aerolens.schema import STREAM_FEATURES
from aerolens.session import materialized, scratch_removed
from aerolens.sources.pieces import FAN, KEY
from aerolens.sources.tables import with_partition

MODEL_VERSION = "online-sgd-v1"
SOURCE = "ingest"
MIN_FOREST_ROWS = 20
FOREST_COLUMNS = ["pm25", "co2_ppm"]


@dataclass(frozen=True)
class KeptForests:
    """The stream's own forests, fitted on a uniform sample of all readings it has stored.

    The sample holds ``sample_rows`` readings at most. Forests are fitted once it has ``min_rows`` and again
    ``refit_batches`` batches after the last fit; a batch is judged by forests of the batches before it.
    """

    sample_rows: int = 25_600
    min_rows: int = 256
    refit_batches: int = 20
    trees: int = 100
    max_samples: int = 256
    seed: int = 42


def stored_baseline(store: Store, batch_id: int) -> tuple[DataFrame, DataFrame] | None:
    """The newest forests fitted before a batch, for PM2.5 and CO2; ``None`` if there are none yet."""
    forests = store.forests_before(SOURCE, batch_id)[1]
    if forests is None:
        return None
    pm25, co2 = (forests.where(F.col("feature_name") == c).drop("feature_name") for c in FOREST_COLUMNS)
    return pm25, co2


def keep_forests(store: Store, batch: DataFrame, batch_id: int, kept: KeptForests) -> None:
    """Add a stored batch to the sample, and fit new forests on it if the last ones are old enough.

    Everything follows from the states before this batch, so a repeated batch writes the same again.
    """
    before = store.sample_before(SOURCE, batch_id)
    sample = merged_sample(before, batch, KEY, FOREST_COLUMNS, size=kept.sample_rows, seed=kept.seed)
    store.save_sample(sample, SOURCE, batch_id)
    fitted = store.forests_before(SOURCE, batch_id)[0]
    if fitted is not None and batch_id - fitted < kept.refit_batches:
        return
    sample = store.sample_before(SOURCE, batch_id + 1)
    if sample is None or sample.limit(kept.min_rows).count() < kept.min_rows:
        return
    fits = [
        # A reading's place is its key here: one text, also where an id has several times.
        fit_isolation_forest(
            sample, [c], trees=kept.trees, max_samples=kept.max_samples, seed=kept.seed, key=PLACE
        ).withColumn("feature_name", F.lit(c))
        for c in FOREST_COLUMNS
    ]
    store.save_forests(fits[0].unionByName(fits[1]), SOURCE, batch_id)


def detect_batch(batch: DataFrame, rows: int, baseline: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Score and flag a batch.

    With a ``baseline``, the node tables of a PM2.5 and a CO2 forest, the most isolated two percent are
    flagged; without one, or on a small batch, rows with a large sum of z-scores.
    """
    if baseline is None or rows < MIN_FOREST_ROWS:
        return zsum_outliers(batch)
    scored = materialized(stream_forest_scores(batch, *baseline), "scores")
    return percentile_outliers(scored)


def admit_batch(
    store: Store, arrived: DataFrame, batch_id: int, check_stations: bool = True, counts: dict | None = None
) -> DataFrame:
    """The rows of a batch that are new and pass all checks, as declared; the others are quarantined or known.

    A reading is new if no other batch has stored its key, ``record_id`` and ``ts``, however late or early the row
    arrives. Stored keys are looked up in the index of the pieces that hold the batch's days. Stations are checked once
    there are any. One pass checks the rows, counts them into ``counts`` and names their days.
    """
    stations = store.stations()
    if not check_stations or stations.limit(1).count() == 0:
        stations = None
    seen = Observation()
    checked = checked_readings(arrived, stations)
    good = F.size("violations") == 0
    checked = checked.observe(
        seen, F.count("*").alias("arrived"), F.count_if(~good).alias("rejected"),
        F.collect_set(F.when(good, F.expr("cast(date_format(ts, 'yyyyMMdd') as int)"))).alias("days"),
    )
    checked = materialized(checked, "checked")
    found = seen.get
    if counts is not None:
        counts |= {name: found[name] for name in ("arrived", "rejected")}
    if found["rejected"]:
        store.append_quarantine(quarantine_rows(checked), batch_id)
    else:
        store.clear_quarantine(batch_id)
    rows = first_per_key(as_declared(checked), KEY, [F.asc("station_id")])
    known = store.known_keys(with_partition(as_declared(checked)), found["days"], but_batch=batch_id)
    return rows if known is None else rows.join(known, KEY, "left_anti").select(*rows.columns)


def process_batch(
    store: Store,
    batch: DataFrame,
    batch_id: int,
    *,
    before: int = 0,
    started: float | None = None,
    baseline: tuple[DataFrame, DataFrame] | KeptForests | None = None,
    check_stations: bool = True,
) -> int:
    """Everything that happens to one micro-batch; returns its number of readings.

    Each table gets the batch under its own ``batch_id``, and the model is updated from the state
    before this batch. So a replay of the batch writes the same rows to the same places.
    ``before`` and ``started`` are the readings and the time since the run began.
    """
    begun = time.monotonic()
    counts: dict[str, int] = {}
    batch = with_aqi_bucket(admit_batch(store, batch, batch_id, check_stations, counts))
    store.append_readings(batch, batch_id)
    latency_ms = (time.monotonic() - begun) * 1000.0
    # The many steps that follow read the stored rows: they are checked once, survive lost
    # executors, and are planned like any table, with the number of tasks fitted to their size.
    batch = store.readings_of_batch(batch_id, batch.schema)
    rows = batch.count()
    store.append_ingest_log(counts["arrived"], counts["rejected"], rows, batch_id)
    if not rows:
        # What an earlier try may have written goes too.
        store.append_alerts(batch_outlier_alerts(zsum_outliers(batch)).select(*ALERT_COLUMNS), SOURCE, batch_id)
        return 0

    kept = baseline if isinstance(baseline, KeptForests) else None
    flagged = detect_batch(batch, rows, stored_baseline(store, batch_id) if kept else baseline)
    alerts = batch_outlier_alerts(flagged).select(*ALERT_COLUMNS).unionByName(
        threshold_alerts(batch).select(*ALERT_COLUMNS)
    )
    store.append_alerts(alerts, SOURCE, batch_id)

    medians = settled(exact_quantiles(batch, STREAM_FEATURES, rows=rows))
    state = update_aqi_model(batch, STREAM_FEATURES, store.model_before(SOURCE, batch_id), medians=medians)
    store.save_model(state, SOURCE, batch_id)
    if kept:
        keep_forests(store, batch, batch_id, kept)
    judged = score_aqi(
        flagged, state, medians=medians, version=MODEL_VERSION, keep=("pm25", "is_anomaly", "aqi_bucket")
    )
    store.append_predictions(judged, batch_id)

    minutes = max((time.monotonic() - (begun if started is None else started)) / 60.0, 1e-6)
    run_figures = store.spark.sql(
        f"select {(before + rows) / minutes}D as ingest_throughput, {latency_ms}D as ingest_latency"
    )
    metrics = batch_metrics(judged).unionByName(
        metric_rows(run_figures, {"ingest_throughput": "rows/min", "ingest_latency": "ms"})
    )
    store.append_metrics(metrics, SOURCE, batch_id, F.current_timestamp())
    return rows


def run_ingest_stream(
    spark: SparkSession,
    readings: DataFrame,
    store: Store,
    *,
    trigger: dict | None = None,
    baseline: tuple[DataFrame, DataFrame] | KeptForests | None = None,
    check_stations: bool = True,
    compact_every: int | None = FAN,
) -> StreamingQuery:
    """Start the stream. Every reading that passes the checks is stored exactly once by its ``record_id`` and ``ts``.

    Every ``compact_every`` batches, those before are put together, so that the table keeps a bounded number of pieces.
    ``baseline`` takes two forests fitted on earlier readings, or ``KeptForests``, with which the stream fits, stores,
    renews and uses its own; without it batches are judged by z-scores. With ``check_stations`` readings of stations the store does not know are quarantined, once it knows any.
    """
    finish_deletes(store)
    started = time.monotonic()
    progress = {"rows": 0}

    def handle(batch: DataFrame, batch_id: int) -> None:
        with scratch_removed(spark):
            progress["rows"] += process_batch(
                store, batch, batch_id, before=progress["rows"], started=started, baseline=baseline,
                check_stations=check_stations,
            )
        # Only the last batch is ever repeated.
        if compact_every and batch_id and batch_id % compact_every == 0:
            store.compact(batch_id, fan=compact_every)

    return (
        readings.writeStream.foreachBatch(handle)
        .option("checkpointLocation", store.path("_checkpoints/ingest"))
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
