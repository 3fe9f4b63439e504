"""The stored tables of one deployment: where they lie and how they are read.

Each writer (the ingest stream, the monitor) appends below its own ``source=`` folder, by day and batch
by batch, so writers never touch each other's files and a repeated batch replaces only itself. Readings and
streamed predictions have one writer besides bulk loads, which are a batch of their own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from aerolens.operators.keyed import absent_rows, retain_latest_metrics
from aerolens.operators.forest import NODES
from aerolens.operators.model import STATE, load_aqi_model, save_aqi_model
from aerolens.schema import ALERTS, PREDICTIONS, READINGS, SENSORS, STATIONS, SYSTEM_METRICS, fields
from aerolens.session import configure
from aerolens.sources import folders
from aerolens.sources.pieces import (
    FAN, GRACE, Piece, all_pieces, check_not_merged, compact, forget_index, known_keys, live_pieces, read_pieces, write_index,
)
from aerolens.sources.tables import (
    BULK, DAY, append_batch, append_readings, latest_ts, partition_column, read_readings, read_table, read_upserted,
    scan_readings, since, upsert_partitions, with_columns, with_partition, write_partitioned,
)

# Predictions also carry the time of their reading, so a time window prunes them like readings.
STORED_PREDICTIONS = with_columns(PREDICTIONS, "ts timestamp")
KEPT_MODELS = 10
INGEST_LOG = "arrived bigint, rejected bigint, known bigint, stored bigint"
QUARANTINE = "record_id bigint, station_id bigint, ts timestamp, violations string, reading string"
ZONE_STEPS = fields("ts timestamp, city_zone string, readings bigint, pm25_sum double, pm25_count bigint, max_pm25 double")
# The key stands for the zone also where it is null.
ZONE_WINDOWS = fields(
    "window_start timestamp, window_end timestamp, city_zone string, readings bigint, avg_pm25 double, max_pm25 double, zone_key string"
)
# A sample of the stored readings and the forests fitted on it, one per feature.
SAMPLE = fields("record_id bigint, ts timestamp, place string, pm25 double, co2_ppm double")
FORESTS = fields(f"feature_name string, {NODES}")
# One row for each training run or rollback; ``chosen`` is the version in use from then on.
REGISTRY = fields(
    "version bigint, recorded_at timestamp, train_rows bigint, held_out_rows bigint, correct bigint, log_loss double,"
    " rival bigint, rival_log_loss double, action string, chosen bigint"
)
ZONE_LOG = "arrived bigint, late bigint, newest timestamp"


class Store:
    """Tables below one folder that all executors can reach.

    ``prediction_unit`` is the time span of one partition of predictions. Every upsert rewrites the
    spans its readings fall into, so it should be no longer than the window a cycle scores.
    """

    def __init__(self, spark: SparkSession, root: str, prediction_unit: str = "hour"):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.prediction_unit = prediction_unit

    def path(self, name: str, source: str | None = None) -> str:
        return f"{self.root}/{name}" if source is None else f"{self.root}/{name}/source={source}"

    # --- reading ---

    def readings(self, minutes: int, as_of: dt.datetime | None = None, columns: list[str] | None = None) -> DataFrame:
        """Trailing window of the readings."""
        return scan_readings(
            self.spark, self.path("readings"), minutes=minutes, as_of=as_of, columns=columns
        )

    def readings_of_batch(self, batch_id: int, schema: T.StructType) -> DataFrame:
        """The readings one batch has appended; only its own folders are listed."""
        found = folders.matching(self.spark, f"{self.path('readings')}/*/batch_id={batch_id}")
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path("readings")).parquet(*found).select(
            *schema.fieldNames()
        )

    def known_keys(self, batch: DataFrame, days: list[int], but_batch: int) -> DataFrame | None:
        """Keys of a batch that other batches have stored; ``None`` if there are none for sure."""
        return known_keys(self.spark, self.path("readings"), READINGS, batch, days, but_batch)

    def quarantine(self) -> DataFrame:
        """Rejected readings with the codes of their violations, and the whole row as JSON."""
        return read_table(self.spark, self.path("quarantine"), fields(QUARANTINE), "batch_id bigint")

    def latest(self) -> dt.datetime | None:
        """Time of the newest reading."""
        return latest_ts(self.spark, self.path("readings"))

    def all_readings(self) -> DataFrame:
        """Every stored reading with ``ts_day`` and ``batch_id``."""
        return read_readings(self.spark, self.path("readings"))

    def ingest_log(self) -> DataFrame:
        """Rows that arrived with each batch, and how many were rejected, known before and stored."""
        return read_table(self.spark, self.path("ingest_log"), fields(INGEST_LOG), "batch_id bigint")

    def stations(self) -> DataFrame:
        return read_table(self.spark, self.path("stations"), STATIONS).select(*STATIONS.fieldNames())

    def sensors(self) -> DataFrame:
        return read_table(self.spark, self.path("sensors"), SENSORS)

    def alerts(self, start: dt.datetime | None = None) -> DataFrame:
        """All alerts, or those of readings from ``start`` on."""
        table = read_table(
            self.spark, self.path("alerts"), ALERTS, "source string", f"{DAY} int", "batch_id bigint"
        )
        return table if start is None else since(table, start, "created_at")

    def predictions(self, start: dt.datetime | None = None) -> DataFrame:
        """All predictions, or those of readings from ``start`` on.

        The monitor's predictions replace those of the ingest stream, which only ever appends.
        """
        column = partition_column(self.prediction_unit)
        span = f"{column} int"
        upserted = read_upserted(self.spark, self.path("predictions"), STORED_PREDICTIONS, column)
        streamed = read_table(
            self.spark, self.path("predictions_streamed"), STORED_PREDICTIONS, span, "batch_id bigint"
        )
        if start is not None:
            upserted, streamed = since(upserted, start), since(streamed, start)
        columns = STORED_PREDICTIONS.fieldNames()
        first_only = streamed.join(upserted.select("record_id"), "record_id", "left_anti")
        return upserted.select(*columns).unionByName(first_only.select(*columns))

    def metrics(self) -> DataFrame:
        return read_table(
            self.spark, self.path("system_metrics"), SYSTEM_METRICS, "source string", "batch_id bigint"
        )

    def zone_windows(self) -> DataFrame:
        """Sliding averages per zone over all readings that have come."""
        table = read_upserted(self.spark, self.path("zone_windows"), ZONE_WINDOWS, DAY)
        return table.select(*ZONE_WINDOWS.fieldNames()).drop("zone_key")

    def zone_steps(self, days: list[int]) -> DataFrame:
        """The partial sums of zones on some days; a step has a row for each batch that brought readings for it."""
        path = self.path("zone_steps")
        pieces = live_pieces(all_pieces(self.spark, path, days=days))
        return read_pieces(self.spark, path, ZONE_STEPS, pieces).where(F.col(DAY).isin(days))

    def zone_steps_of_batch(self, batch_id: int) -> DataFrame:
        path = self.path("zone_steps")
        found = folders.matching(self.spark, f"{path}/{DAY}=*/batch_id={batch_id}")
        return read_pieces(self.spark, path, ZONE_STEPS, [Piece(batch_id, batch_id, tuple(found))] if found else [])

    def zone_log(self) -> DataFrame:
        """Located readings of each batch of the zone stream, how many came late, and the newest time so far."""
        return read_table(self.spark, self.path("zone_log"), fields(ZONE_LOG), "batch_id bigint")

    # --- writing ---

    def append_zone_steps(self, steps: DataFrame, batch_id: int) -> None:
        path = self.path("zone_steps")
        check_not_merged(self.spark, path, batch_id)
        append_batch(with_partition(steps), path, batch_id, partition_by=(DAY,))

    def compact_zone_steps(self, below: int, *, fan: int = FAN, grace: float = GRACE) -> None:
        compact(self.spark, self.path("zone_steps"), ZONE_STEPS, below, fan=fan, grace=grace)

    def upsert_zone_windows(self, windows: DataFrame) -> None:
        """Replace or add whole windows; days without any are not touched."""
        keyed = windows.withColumn("zone_key", F.to_json(F.struct("city_zone")))
        upsert_partitions(
            self.spark, self.path("zone_windows"), with_partition(keyed, "day", "window_start"), ZONE_WINDOWS,
            ["zone_key", "window_start"], [F.asc("window_end")], DAY,
        )

    def append_zone_log(self, times: DataFrame, batch_id: int, lateness: dt.timedelta) -> None:
        """Count the batch; only the row of the batch before is read for the newest time."""
        before = read_table(self.spark, f"{self.path('zone_log')}/batch_id={batch_id - 1}", fields(ZONE_LOG))
        # Epoch microseconds, so nothing depends on the Python process's time zone.
        last = before.select(F.unix_micros("newest")).first()
        newest = "cast(null as timestamp)" if last is None or last[0] is None else f"timestamp_micros({last[0]}L)"
        margin = f"make_dt_interval(0, 0, 0, {lateness.total_seconds()})"
        counted = times.agg(
            F.expr("count(*) as arrived"), F.expr(f"count_if(ts < {newest} - {margin}) as late"),
            F.expr(f"greatest(max(ts), {newest}) as newest"),
        )
        append_batch(counted.coalesce(1), self.path("zone_log"), batch_id)

    def append_readings(self, readings: DataFrame, batch_id: int) -> None:
        """Append a batch and the index of its keys."""
        path = self.path("readings")
        append_readings(readings, path, batch_id)
        written = folders.matching(self.spark, f"{path}/{DAY}=*/batch_id={batch_id}")
        if written:
            write_index(self.spark, path, READINGS, Piece(batch_id, batch_id, tuple(written)))

    def load_readings(self, readings: DataFrame) -> None:
        """Load a history in bulk, as one batch with an index of its keys."""
        path = self.path("readings")
        forget_index(self.spark, path, BULK)
        write_partitioned(readings, path)
        written = folders.matching(self.spark, f"{path}/{DAY}=*/batch_id={BULK}")
        if written:
            write_index(self.spark, path, READINGS, Piece(BULK, BULK, tuple(written)))

    def compact(self, below: int, *, fan: int = FAN, grace: float = GRACE) -> None:
        """Put together the readings of the batches below ``below``, which no stream may repeat any more."""
        compact(self.spark, self.path("readings"), READINGS, below, fan=fan, grace=grace, index=True)

    def append_ingest_log(self, arrived: int, rejected: int, stored: int, batch_id: int) -> None:
        row = self.spark.createDataFrame([(arrived, rejected, arrived - rejected - stored, stored)], INGEST_LOG)
        append_batch(row.coalesce(1), self.path("ingest_log"), batch_id)

    def add_stations(self, stations: DataFrame, batch_id: int) -> None:
        """Add the stations that are not at a known place yet."""
        place = ["city_zone", "latitude", "longitude"]
        table = read_table(self.spark, self.path("stations"), STATIONS, "batch_id bigint")
        known = table.where(F.col("batch_id") != batch_id)
        added = absent_rows(known, stations, place, [F.asc("station_id")])
        append_batch(added.select(*STATIONS.fieldNames()), self.path("stations"), batch_id)

    def append_predictions(self, scored: DataFrame, batch_id: int) -> None:
        """Append predictions of new readings; nothing is rewritten."""
        rows = with_partition(scored.select(*STORED_PREDICTIONS.fieldNames()), self.prediction_unit)
        append_batch(rows, self.path("predictions_streamed"), batch_id, (partition_column(self.prediction_unit),))

    def append_alerts(self, alerts: DataFrame, source: str, batch_id: int) -> None:
        """Append alerts, which are open, with the day of their reading.

        An alert's id is a hash of its reading and rule, so it is the same when the batch is repeated.
        """
        opened = alerts.withColumns({
            "status": F.lit("Open"),
            "alert_id": F.xxhash64("record_id", "alert_type", "detection_method", F.lit(source)),
        })
        rows = with_partition(opened, "day", "created_at")
        append_batch(rows, self.path("alerts", source), batch_id, (DAY,))

    def append_quarantine(self, rejected: DataFrame, batch_id: int) -> None:
        """Keep rejected rows whole, as text, so that no type can stop them."""
        columns = [c for c in rejected.columns if c != "violations"]
        rows = rejected.select(
            "record_id", "station_id", "ts", F.array_join("violations", ",").alias("violations"),
            F.to_json(F.struct(*columns)).alias("reading"),
        )
        append_batch(rows, self.path("quarantine"), batch_id)

    def clear_quarantine(self, batch_id: int) -> None:
        """Remove what an earlier try of a batch rejected."""
        folders.remove(self.spark, f"{self.path('quarantine')}/batch_id={batch_id}")

    def upsert_predictions(self, scored: DataFrame) -> None:
        """Insert or replace predictions by record; only the time spans of the given readings are rewritten."""
        upsert_partitions(
            self.spark, self.path("predictions"), with_partition(scored, self.prediction_unit), STORED_PREDICTIONS,
            ["record_id"], [F.desc("predicted_at")], partition_column(self.prediction_unit),
        )

    def append_metrics(self, metrics: DataFrame, source: str, batch_id: int, recorded_at: Column) -> None:
        """Append named values. An id is a hash of writer, batch and name, so a repeated batch has the same ids."""
        rows = metrics.withColumn("recorded_at", recorded_at).selectExpr(
            f"xxhash64('{source}', {batch_id}L, metric_name) as metric_id",
            "metric_name", "cast(metric_value as double) as metric_value", "metric_unit", "recorded_at",
        )
        append_batch(rows.coalesce(1), self.path("system_metrics", source), batch_id)

    def retain_metrics(self, keep: int = 1000) -> None:
        """Remove the batches of all writers that have no row among the newest ``keep``.

        Nothing is rewritten, so a run that fails loses nothing and can be repeated. The batch in which the
        newest rows begin stays whole.
        """
        kept = retain_latest_metrics(self.metrics(), keep).select("source", "batch_id").distinct().collect()
        kept_folders = {f"source={row['source']}/batch_id={row['batch_id']}" for row in kept}
        for folder in folders.matching(self.spark, f"{self.path('system_metrics')}/source=*/batch_id=*"):
            if "/".join(folder.split("/")[-2:]) not in kept_folders:
                folders.remove(self.spark, folder)

    def save_full_model(self, model: PipelineModel, name: str, version: int) -> None:
        """Keep a fully trained model as one version; the newest loads, so a failed save changes nothing."""
        save_aqi_model(model, f"{self.path('full_model', name)}/version={version}")

    def full_model(self, name: str) -> PipelineModel | None:
        """The newest completely saved model; ``None`` when there is none."""
        found = {
            int(mark.split("version=")[1].split("/")[0]): mark.removesuffix("/metadata/_SUCCESS")
            for mark in folders.matching(self.spark, f"{self.path('full_model', name)}/version=*/metadata/_SUCCESS")
        }
        for version in sorted(found, reverse=True):
            if folders.matching(self.spark, f"{found[version]}/stages/*/data/_SUCCESS"):
                return load_aqi_model(found[version])
        return None

    def model_registry(self) -> DataFrame:
        """All entries of all models; ``source`` is the model's name."""
        return read_table(self.spark, self.path("model_registry"), REGISTRY, "source string", "batch_id bigint")

    def register_model(self, entry: dict, name: str, version: int) -> None:
        """Write an entry, in place of one of the same version."""
        row = self.spark.createDataFrame([tuple(entry.get(c) for c in REGISTRY.fieldNames())], REGISTRY)
        append_batch(row.coalesce(1), self.path("model_registry", name), version)

    def unregister_model(self, name: str, version: int) -> None:
        """Remove an entry, so that the one before it counts while its model is replaced."""
        folders.remove(self.spark, f"{self.path('model_registry', name)}/batch_id={version}")

    def chosen_version(self, name: str, before: int | None = None) -> int | None:
        """The version of a fully trained model that is in use, by the newest entry (older than ``before``)."""
        newest = self._newest_before("model_registry", REGISTRY, name, before, keep=None)[1]
        return None if newest is None else newest.first()["chosen"]

    def full_model_version(self, name: str, version: int) -> PipelineModel:
        return load_aqi_model(f"{self.path('full_model', name)}/version={version}")

    def save_model(self, state: DataFrame, source: str, version: int) -> None:
        append_batch(state.coalesce(1), self.path("model", source), version)

    def model_before(self, source: str, version: int) -> DataFrame | None:
        """The newest model state older than ``version``; ``None`` when there is none."""
        return self._newest_before("model", fields(STATE), source, version)[1]

    def save_sample(self, sample: DataFrame, source: str, version: int) -> None:
        """Keep the sample of the readings up to a batch; it is bounded, so one file holds it."""
        append_batch(sample.select(*SAMPLE.fieldNames()).coalesce(1), self.path("sample", source), version)

    def sample_before(self, source: str, version: int) -> DataFrame | None:
        return self._newest_before("sample", SAMPLE, source, version)[1]

    def save_forests(self, forests: DataFrame, source: str, version: int) -> None:
        """Keep the node tables of one fit as a version; readers go on with the one before until it is whole."""
        append_batch(forests.select(*FORESTS.fieldNames()).coalesce(1), self.path("forests", source), version)

    def forests_before(self, source: str, version: int) -> tuple[int | None, DataFrame | None]:
        """The newest forests older than ``version``, with the batch they were fitted after."""
        return self._newest_before("forests", FORESTS, source, version)

    def _newest_before(
        self, name: str, schema: T.StructType, source: str, version: int | None, keep: int | None = KEPT_MODELS
    ) -> tuple[int | None, DataFrame | None]:
        """The newest state older than ``version`` and its version.

        Found by the folders' names, so only the file of one state is opened. Of the older states the newest
        ``keep`` stay, ``None`` keeps all: a repeated batch needs the one before it.
        """
        found = {
            int(folder.rpartition("=")[2]): folder
            for folder in folders.matching(self.spark, f"{self.path(name, source)}/batch_id=*")
        }
        older = sorted(v for v in found if version is None or v < version)
        for stale in older[:-keep] if keep else []:
            folders.remove(self.spark, found[stale])
        return (older[-1], read_table(self.spark, found[older[-1]], schema)) if older else (None, None)
