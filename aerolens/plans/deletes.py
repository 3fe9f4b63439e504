"""Deleting stations from the stored tables, with all that hangs on them.

What is to go is written down first, whole: the stations, their sensors and the readings of both. From then on the delete
happens, whatever step a run is lost at: the next ``finish_deletes`` goes through the tables again. A table's partitions
that hold such a row are staged without it and then replaced; a complete stage is replaced again by the next run, an
incomplete one is made anew, as the table had not been touched.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from aerolens.plans.store import STORED_PREDICTIONS, Store
from aerolens.schema import ALERTS, READINGS, SENSORS, STATIONS, fields
from aerolens.session import scratch_removed
from aerolens.sources import folders
from aerolens.sources.pieces import INDEX, MERGED, all_pieces, live_pieces, write_index
from aerolens.sources.tables import DAY, finish_upsert, partition_column, read_table

INTENTS = "_deletes"
STAGE, TOUCHED = "_without", "_touched"
#: Written last, so an intent with it is complete.
LAST = "readings"


def _intent(store: Store, name: str, part: str, schema: str) -> DataFrame:
    return store.spark.read.schema(fields(schema)).parquet(f"{store.path(INTENTS)}/{name}/{part}")


def delete_stations(store: Store, stations: DataFrame) -> None:
    """Delete the given ``station_id`` with their sensors, readings, alerts and predictions.

    Null ids delete nothing, unknown ones what still refers to them. Rows that a stream stores after the delete was
    written down are not part of it.
    """
    root = f"{store.path(INTENTS)}/{uuid.uuid4().hex}"
    gone = stations.select("station_id").where("station_id is not null").distinct()
    gone.write.parquet(f"{root}/stations")
    gone = store.spark.read.schema(gone.schema).parquet(f"{root}/stations")
    store.sensors().join(gone, "station_id", "left_semi").select("sensor_id").where("sensor_id is not null").distinct().write.parquet(
        f"{root}/sensors"
    )
    sensors = store.spark.read.schema(fields("sensor_id bigint")).parquet(f"{root}/sensors")
    readings = store.all_readings()
    lost = readings.join(gone, "station_id", "left_semi").select("record_id").union(
        readings.join(sensors, "sensor_id", "left_semi").select("record_id")
    )
    lost.distinct().write.parquet(f"{root}/{LAST}")
    finish_deletes(store)


def finish_deletes(store: Store) -> int:
    """Carry out what was written down and not finished; returns how many deletes that were."""
    done = 0
    for folder in folders.matching(store.spark, f"{store.path(INTENTS)}/*"):
        name = folder.rpartition("/")[2]
        if folders.exists(store.spark, f"{folder}/{LAST}/_SUCCESS"):
            with scratch_removed(store.spark):
                _carry_out(store, name)
            done += 1
        folders.remove(store.spark, folder)
    return done


def _carry_out(store: Store, name: str) -> None:
    spark = store.spark
    by = {
        "station_id": _intent(store, name, "stations", "station_id bigint"),
        "sensor_id": _intent(store, name, "sensors", "sensor_id bigint"),
        "record_id": _intent(store, name, LAST, "record_id bigint"),
    }
    unit = f"{partition_column(store.prediction_unit)} int"
    batched = "batch_id bigint" if folders.matching(spark, f"{store.path('stations')}/batch_id=*") else None
    plan = [
        ("stations", STATIONS, [batched] if batched else [], ["station_id"]),
        ("sensors", SENSORS, [], ["station_id"]),
        ("alerts", ALERTS, ["source string", f"{DAY} int", "batch_id bigint"], ["station_id", "record_id"]),
        ("predictions", STORED_PREDICTIONS, [unit], ["station_id", "record_id"]),
        ("predictions_streamed", STORED_PREDICTIONS, [unit, "batch_id bigint"], ["station_id", "record_id"]),
    ]
    # An upsert lost while it replaced partitions comes first, or it would bring rows back.
    finish_upsert(spark, store.path("predictions"), STORED_PREDICTIONS, partition_column(store.prediction_unit))
    for table, schema, partitions, keys in plan:
        rewrite_without(spark, store.path(table), schema, partitions, {k: by[k] for k in keys})
    # Readings as they came, and those that were put together, whose batch is in the rows.
    path, keys = store.path("readings"), {k: by[k] for k in ("station_id", "sensor_id")}
    whole = T.StructType(READINGS.fields + fields("batch_id bigint").fields)
    rewrite_without(spark, path, READINGS, [f"{DAY} int", "batch_id bigint"], keys, lambda rows: _forget(store, rows))
    rewrite_without(spark, f"{path}/{MERGED}", whole, ["range string", f"{DAY} int"], keys, lambda rows: _forget(store, rows))
    for piece in live_pieces(all_pieces(spark, path)):
        if not folders.exists(spark, f"{path}/{INDEX}/{piece.name}/_SUCCESS"):
            write_index(spark, path, READINGS, piece)


def _forget(store: Store, touched: list) -> None:
    """Remove the index of pieces that lose rows; it is written anew when all have lost theirs."""
    names = {row["range"] if "range" in row.asDict() else f"{row['batch_id']}_{row['batch_id']}" for row in touched}
    for name in names:
        folders.remove(store.spark, f"{store.path('readings')}/{INDEX}/{name}")


def rewrite_without(
    spark: SparkSession, path: str, schema: T.StructType, partitions: list[str], keys: dict[str, DataFrame],
    before: Callable[[list], None] | None = None,
) -> None:
    """Remove the rows with one of ``keys``; only the partitions (``name type``) that hold such rows are written.

    ``before`` is told of these partitions before the first is replaced.
    """
    if not folders.exists(spark, path):
        return
    columns = [p.split()[0] for p in partitions]
    staged, touched = f"{path}/{STAGE}", f"{path}/{TOUCHED}"
    if not folders.exists(spark, f"{staged}/_SUCCESS"):
        rows = read_table(spark, path, schema, *partitions)
        hit = None
        for key, lost in keys.items():
            found = rows.join(lost, key, "left_semi").select(*columns, F.lit(1).alias("hit"))
            hit = found if hit is None else hit.union(found)
        hit.distinct().write.mode("overwrite").parquet(touched)
        where = _read_touched(spark, touched, partitions)
        if not where.limit(1).count():
            folders.remove(spark, touched)
            return
        if columns:
            # As many rows as partitions; null-safe, as a partition may be that of nulls.
            same = [F.col(f"k.{c}").eqNullSafe(F.col(f"t.{c}")) for c in columns]
            rows = rows.alias("k").join(where.alias("t"), same, "left_semi")
        for key, lost in keys.items():
            rows = rows.join(lost, key, "left_anti")
        names = [*schema.fieldNames(), *columns]
        rows.select(*names).hint("rebalance", *columns).write.mode("overwrite").parquet(staged)
    _replace(spark, path, schema, partitions, before)


def _read_touched(spark: SparkSession, path: str, partitions: list[str]) -> DataFrame:
    return spark.read.schema(fields(", ".join([*partitions, "hit int"]))).parquet(path)


def _replace(
    spark: SparkSession, path: str, schema: T.StructType, partitions: list[str], before: Callable[[list], None] | None
) -> None:
    """Put the staged rows in the place of the touched partitions; running it again does the same."""
    columns = [p.split()[0] for p in partitions]
    full = T.StructType(schema.fields + (fields(", ".join(partitions)).fields if partitions else []))
    staged, touched = f"{path}/{STAGE}", f"{path}/{TOUCHED}"
    rows = spark.read.schema(full).parquet(staged)
    if columns:
        # A row for each touched partition, as their folders are replaced one by one.
        named = _read_touched(spark, touched, partitions).select(*columns).collect()
        if before is not None:
            before(named)
        left = {tuple(row) for row in rows.select(*columns).distinct().collect()}
        rows.hint("rebalance", *columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *columns
        ).parquet(path)
        for row in named:
            if tuple(row) not in left:
                folders.remove(spark, "/".join([path, *(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(columns, row))]))
    else:
        # The new files are added under one batch of names, then the old ones go; a row may be there twice in between.
        old = [f for f in folders.matching(spark, f"{path}/*.parquet")]
        rows.write.mode("append").parquet(path)
        for file in old:
            folders.remove(spark, file)
    folders.remove(spark, staged)
    folders.remove(spark, touched)
