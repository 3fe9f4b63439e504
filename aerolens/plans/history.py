"""Lineage over long spans: readings, predictions and alerts stored side by side in buckets of ``record_id``.

The three tables are shuffled once, when a span is written; each lineage over it then joins bucket by bucket
and sorts nothing that large. Tables are external ones below the store, so any session can read them.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, functions as F

from aerolens.plans.store import Store
from aerolens.session import scratch_removed
from aerolens.sources import folders
from aerolens.sources.tables import timestamp_literal

KEY = "record_id"
TABLES = {
    "readings": "record_id bigint, station_id bigint, sensor_id bigint, pm25 double, ts timestamp",
    "predictions": "record_id bigint, aqi_pred string",
    "alerts": "record_id bigint, alert_type string, severity string",
}
ROWS_A_BUCKET = 2_000_000


def write_history(store: Store, start: dt.datetime, end: dt.datetime, *, version: int, buckets: int | None = None) -> None:
    """Store all readings of a span (``end`` excluded) with their predictions and alerts as one version.

    It shows the span as it is now; write a higher version to renew it. ``buckets`` defaults to one for every two million
    readings; all three tables have the same number. A version counts once all three are whole, and an unfinished or
    older one with the same number is replaced.
    """
    begin, stop = timestamp_literal(start), timestamp_literal(end)
    minutes = int((end - start).total_seconds() // 60) + 1
    readings = store.readings(minutes, end).where((F.col("ts") >= begin) & (F.col("ts") < stop))
    parts = {
        "readings": readings,
        "predictions": store.predictions(start).where(F.col("ts") < stop),
        "alerts": store.alerts(start).where(F.col("created_at") < stop),
    }
    buckets = buckets or 1 + readings.count() // ROWS_A_BUCKET
    # The mark of the last table makes a version whole, so it is the first to go.
    root = store.path("history")
    for name in reversed(list(TABLES)):
        for old in folders.matching(store.spark, f"{root}/version={version}/{name}-buckets=*"):
            folders.remove(store.spark, old)
    with scratch_removed(store.spark):
        for name, schema in TABLES.items():
            columns = [c.split()[0] for c in schema.split(", ")]
            path = f"{root}/version={version}/{name}-buckets={buckets}"
            # One task a bucket writes one file, which a join reads as it is sorted.
            (
                parts[name].select(*columns).repartition(buckets, KEY)
                .write.mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY).option("path", path)
                .saveAsTable(_registered(store, path))
            )


def history(store: Store) -> dict[str, DataFrame] | None:
    """The three tables of the newest whole version; ``None`` if there is none."""
    last = list(TABLES)[-1]
    found = {
        int(mark.split("/version=")[1].split("/")[0]): int(mark.split("-buckets=")[1].split("/")[0])
        for mark in folders.matching(store.spark, f"{store.path('history')}/version=*/{last}-buckets=*/_SUCCESS")
    }
    if not found:
        return None
    version = max(found)
    return {name: _table(store, version, name, found[version]) for name in TABLES}


def _table(store: Store, version: int, name: str, buckets: int) -> DataFrame:
    path = f"{store.path('history')}/version={version}/{name}-buckets={buckets}"
    table = _registered(store, path)
    store.spark.sql(
        f"create table if not exists {table} ({TABLES[name]}) using parquet"
        f" clustered by ({KEY}) sorted by ({KEY}) into {buckets} buckets location '{path}'"
    )
    store.spark.catalog.refreshTable(table)
    return store.spark.table(table)


def _registered(store: Store, path: str) -> str:
    """A name for the session's catalog that follows from the folder."""
    return "aerolens_history_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def history_lineage(store: Store) -> DataFrame | None:
    """Readings of the newest span with station, sensor, prediction and alerts, one row per alert.

    Rows as ``operators.joins.reading_lineage`` gives them, without an order. The three large tables are joined first and
    stay in their buckets; stations and sensors come to them, broadcast where Spark finds them small.
    """
    tables = history(store)
    if tables is None:
        return None
    return (
        side_by_side(tables)
        .join(store.stations().select("station_id", "station_name", "city_zone"), "station_id")
        .join(store.sensors().select("sensor_id", "sensor_type"), "sensor_id")
        .select(
            "record_id", "station_name", "city_zone", "sensor_type", "pm25", "ts", "aqi_pred", "alert_type", "severity"
        )
    )


def side_by_side(tables: dict[str, DataFrame]) -> DataFrame:
    """The three tables joined bucket by bucket."""
    return tables["readings"].join(tables["predictions"], KEY, "left").join(tables["alerts"], KEY, "left")
