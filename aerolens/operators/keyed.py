"""Keyed changes of tables: insert if absent, upsert, retention, cascading delete."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first in the given order.

    Spark keeps only the first row per key in each task before the shuffle, so many copies of
    one key do not meet in one task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def absent_rows(existing: DataFrame, new: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The rows an insert that skips known keys would add. A row with a NULL in its key clashes with none.

    The large existing table is first cut down to the keys that also occur in the batch; a small
    batch is sent to its tasks by Spark's own size check, so the table is not shuffled.
    """
    whole = " and ".join(f"{key} is not null" for key in keys)
    batch = first_per_key(new.where(whole), keys, order).unionByName(new.where(f"not ({whole})"))
    known = existing.select(*keys).join(batch.select(*keys), keys, "left_semi")
    return batch.join(known, keys, "left_anti")


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: list[str], order: list) -> DataFrame:
    """``existing`` plus the rows of ``new`` whose key it does not hold."""
    added = absent_rows(existing, new, keys, order)
    return existing.unionByName(added.select(*existing.columns))


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], order: list) -> DataFrame:
    """``existing`` with rows replaced or added by the first row per key of ``new``."""
    latest = first_per_key(new, keys, order)
    kept = existing.join(latest.select(*keys), keys, "left_anti")
    return kept.select(*existing.columns).unionByName(latest.select(*existing.columns))


def newest_metrics_order() -> list:
    """Newest first; a missing time counts as newest, as in a descending database sort."""
    return [F.desc_nulls_first("recorded_at"), F.desc("metric_id")]


def retain_latest_metrics(metrics: DataFrame, keep: int = 1000) -> DataFrame:
    """The newest rows, found as a top-k per task and then overall."""
    return metrics.orderBy(*newest_metrics_order()).limit(keep)


def expired_metrics(metrics: DataFrame, keep: int = 1000) -> DataFrame:
    """The rows that retention removes."""
    kept = retain_latest_metrics(metrics, keep).select("metric_id")
    # Spark sends the kept ids to all tasks if they are few enough.
    return metrics.join(kept, "metric_id", "left_anti")


def cascade_delete(deleted: DataFrame, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What is left of each table when the ``deleted`` stations go with all that hangs on them.

    ``tables`` may hold stations, sensors, readings, alerts and predictions. Alerts and predictions
    go with their station or with their reading.
    """
    gone = deleted.select("station_id").distinct()
    left = {
        name: df.join(gone, "station_id", "left_anti").select(*df.columns) for name, df in tables.items()
    }
    if "readings" in tables:
        lost_sensors = (
            tables["sensors"].join(gone, "station_id", "left_semi").select("sensor_id")
            if "sensors" in tables else None
        )
        readings = tables["readings"]
        lost = readings.join(gone, "station_id", "left_semi").select("record_id")
        if lost_sensors is not None:
            by_sensor = readings.join(lost_sensors, "sensor_id", "left_semi").select("record_id")
            left["readings"] = left["readings"].join(lost_sensors, "sensor_id", "left_anti").select(*readings.columns)
            lost = lost.unionByName(by_sensor)
        for name in ("alerts", "predictions"):
            if name in tables:
                left[name] = left[name].join(lost, "record_id", "left_anti").select(*tables[name].columns)
    return left
