"""Scans, partitioned writes and replay-safe appends of Parquet tables."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from aerolens.operators.keyed import upsert
from aerolens.schema import READINGS, fields
from aerolens.sources import folders
# Stored tables are cut by day first and by batch below, so a window lists the folders of its days only.
from aerolens.sources.pieces import (
    DAY, all_pieces, check_not_merged, forget_index, latest_time, live_pieces, merged_ranges, read_pieces,
)

#: The batch of rows that were loaded in bulk.
BULK = -1

# Time partition columns and their text patterns; the values are integers such as 2024010123.
PARTITIONS = {"month": "yyyyMM", "day": "yyyyMMdd", "hour": "yyyyMMddHH"}


def with_columns(schema: T.StructType, *columns: str) -> T.StructType:
    """A schema with further columns, each given as ``name type``."""
    return T.StructType(schema.fields + fields(", ".join(columns)).fields)


def partition_column(unit: str) -> str:
    return f"ts_{unit}"


def with_partition(df: DataFrame, unit: str = "day", time_column: str = "ts") -> DataFrame:
    """Add a time partition column."""
    text = f"cast(date_format({time_column}, '{PARTITIONS[unit]}') as int)"
    return df.withColumn(partition_column(unit), F.expr(text))


def write_partitioned(
    df: DataFrame, path: str, mode: str = "overwrite", unit: str = "day", batch_id: int = BULK
) -> None:
    """Write readings in bulk, by day and as one batch, so that streams can append to the same table.

    Rows are ranged by time, so a busy day or station is spread over many tasks and each
    file covers a short time span; inside a file they are sorted by station for row-group skipping.
    """
    (
        with_partition(df, unit)
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .repartitionByRange("ts", "record_id")
        .sortWithinPartitions(partition_column(unit), "station_id", "ts")
        .write.mode(mode)
        .partitionBy(partition_column(unit), "batch_id")
        .parquet(path)
    )


EPOCH = dt.datetime(1970, 1, 1)


def latest_ts(spark: SparkSession, path: str, schema: T.StructType = READINGS) -> dt.datetime | None:
    """Newest time of the stored readings: from the index of their pieces, of the others from their newest day only."""
    micros, others = latest_time(spark, path, live_pieces(all_pieces(spark, path)))
    newest = micros
    if others:
        # Folders are named by day, so only the newest is opened.
        rows = read_pieces(spark, path, schema, others)
        if not any(p.merged for p in others):
            last = max(int(folder.split("/")[-2].rpartition("=")[2]) for p in others for folder in p.paths)
            rows = rows.where(F.col(DAY) == last)
        # Epoch microseconds, so the result does not depend on the Python process's time zone.
        found = rows.agg(F.expr("unix_micros(max(ts))")).first()[0]
        newest = max((m for m in (micros, found) if m is not None), default=None)
    return None if newest is None else EPOCH + dt.timedelta(microseconds=newest)


def timestamp_literal(moment: dt.datetime):
    """A UTC timestamp literal from a naive UTC datetime."""
    return F.expr(f"timestamp_micros({(moment - EPOCH) // dt.timedelta(microseconds=1)}L)")


def partition_number(moment: dt.datetime, unit: str) -> int:
    digits = moment.strftime("%Y%m%d%H")
    return int(digits[: len(PARTITIONS[unit])])


def since(df: DataFrame, start: dt.datetime, time_column: str = "ts") -> DataFrame:
    """Rows from ``start`` on, also bounded by the table's time partitions as literals.

    So Spark drops older partitions while it plans, and skips row groups by their time range.
    """
    kept = df
    for unit in PARTITIONS:
        if partition_column(unit) in df.columns:
            kept = kept.where(F.col(partition_column(unit)) >= partition_number(start, unit))
    return kept.where(F.col(time_column) >= timestamp_literal(start))


def read_readings(spark: SparkSession, path: str, schema: T.StructType = READINGS, since_day: int | None = None) -> DataFrame:
    """All stored readings with ``ts_day`` and ``batch_id``, also where batches have been put together."""
    if not merged_ranges(spark, path):
        return read_table(spark, path, schema, f"{DAY} int", "batch_id bigint")
    return read_pieces(spark, path, schema, live_pieces(all_pieces(spark, path, since_day)))


def scan_readings(
    spark: SparkSession,
    path: str,
    *,
    minutes: int,
    as_of: dt.datetime | None = None,
    columns: list[str] | None = None,
    schema: T.StructType = READINGS,
) -> DataFrame:
    """Trailing-window scan with column subset.

    ``as_of`` is a naive UTC time, by default the newest one stored.
    """
    as_of = as_of or latest_ts(spark, path, schema)
    if as_of is None:
        window = read_readings(spark, path, schema).where("false")
    else:
        start = as_of - dt.timedelta(minutes=minutes)
        window = since(read_readings(spark, path, schema, partition_number(start, "day")), start)
    return window.select(*columns) if columns else window


def stream_readings(
    spark: SparkSession, landing: str, schema, *, files_per_batch: int = 100
) -> DataFrame:
    """Micro-batches of the Parquet files that land in a folder."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
    )


def append_batch(df: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    """Append one batch: its own ``batch_id`` folder below each of the ``partition_by`` folders it has rows for.

    Writing a batch again first removes all its folders, so a replay replaces the whole batch also
    if it has other or fewer rows, and one after a lost executor or driver adds nothing.
    """
    spark = df.sparkSession
    for folder in folders.matching(spark, "/".join([path, *["*"] * len(partition_by), f"batch_id={batch_id}"])):
        folders.remove(spark, folder)
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("append")
        .partitionBy(*partition_by, "batch_id")
        .parquet(path)
    )


def append_readings(df: DataFrame, path: str, batch_id: int) -> None:
    """Append readings; their keys travel with the rows, so no ids are read back."""
    check_not_merged(df.sparkSession, path, batch_id)
    forget_index(df.sparkSession, path, batch_id)
    append_batch(with_partition(df), path, batch_id, partition_by=(DAY,))


def read_table(spark: SparkSession, path: str, schema: T.StructType, *partitions: str) -> DataFrame:
    """Read a table with its partition columns (``name type``); empty if nothing was written yet."""
    full = with_columns(schema, *partitions) if partitions else schema
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def upsert_partitions(
    spark: SparkSession, path: str, new: DataFrame, schema: T.StructType, keys: list[str], order: list,
    partition: str,
) -> None:
    """Upsert ``new`` into a table partitioned by ``partition``, rewriting touched partitions only.

    A key must always fall into the same partition. The merged rows are first staged beside the table
    and only then replace the partitions, so the table is never read while it is overwritten. A run that
    failed while it replaced them is finished by the next one, or by ``finish_upsert``.
    """
    finish_upsert(spark, path, schema, partition, new.schema[partition].dataType.simpleString())
    touched = [row[0] for row in new.select(partition).distinct().collect()]
    if not touched:
        return
    field = f"{partition} {new.schema[partition].dataType.simpleString()}"
    existing = read_table(spark, path, schema, field)
    merged = upsert(
        existing.where(F.col(partition).isin(touched)),
        new.select(*schema.fieldNames(), partition),
        keys,
        order,
    )
    # Rebalancing gives each partition few files, and splits one that is too large for a task.
    merged.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(f"{path}/{STAGE}")
    finish_upsert(spark, path, schema, partition, new.schema[partition].dataType.simpleString())


#: Spark does not read folders that begin with an underscore as part of a table.
STAGE = "_staged"


def finish_upsert(spark: SparkSession, path: str, schema: T.StructType, partition: str, kind: str = "int") -> None:
    """Replace the partitions of a completely staged upsert, if there is one.

    A stage without Spark's mark of success was not complete, and the table had not been touched.
    """
    staged = f"{path}/{STAGE}"
    if folders.exists(spark, f"{staged}/_SUCCESS"):
        # Each staged file is of one partition, so the rows need not be dealt out again.
        (
            read_table(spark, staged, schema, f"{partition} {kind}")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(path)
        )
        folders.remove(spark, staged)


def read_upserted(spark: SparkSession, path: str, schema: T.StructType, partition: str, kind: str = "int") -> DataFrame:
    """A table of ``upsert_partitions`` as it will be when the last upsert is finished; nothing is written.

    While an upsert replaces partitions, or after it was lost there, these are read where they are staged whole.
    """
    field = f"{partition} {kind}"
    table = read_table(spark, path, schema, field)
    if not folders.exists(spark, f"{path}/{STAGE}/_SUCCESS"):
        return table
    spans = {folder.rpartition("=")[2] for folder in folders.matching(spark, f"{path}/{STAGE}/{partition}=*")}
    staged = read_table(spark, f"{path}/{STAGE}", schema, field)
    return table.where(~F.col(partition).cast("string").isin(sorted(spans))).unionByName(staged)
