"""Event-time sliding averages per zone, closed by a watermark or corrected whenever late readings come."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolens.operators.series import combine_steps, zone_windows
from aerolens.plans.store import ZONE_STEPS, Store
from aerolens.sources.pieces import FAN


def stream_zone_windows(
    readings: DataFrame, stations: DataFrame, *, lateness: str = "2 minutes",
    minutes: int = 60, slide_minutes: int = 1,
) -> DataFrame:
    """Streaming form of ``zone_windows``: emits a window once the watermark has passed it.

    The stream keeps one row per zone and step, then one per zone and window; both leave the
    state behind the watermark. Readings behind it are left out; ``run_zone_stream`` takes them in.
    """
    located = readings.withWatermark("ts", lateness).join(
        stations.select("station_id", "city_zone"), "station_id"
    )
    return zone_windows(located.select("city_zone", "ts", F.col("pm25")), minutes, slide_minutes)


def zone_steps(located: DataFrame, slide_minutes: int) -> DataFrame:
    """One row per zone and step, as ``ZONE_STEPS``; rows of several batches add up."""
    return located.where("ts is not null").groupBy(
        "city_zone", F.window("ts", f"{slide_minutes} minutes").alias("step")
    ).agg(
        F.expr("count(*) as readings"), F.expr("sum(pm25) as pm25_sum"), F.expr("count(pm25) as pm25_count"),
        F.expr("max(pm25) as max_pm25"),
    ).selectExpr("step.start as ts", *ZONE_STEPS.fieldNames()[1:])


def corrected_windows(steps: DataFrame, new: DataFrame, minutes: int, slide_minutes: int) -> DataFrame:
    """The windows that contain a step of ``new``, over all of ``steps``.

    Only the steps of a zone that can lie in such a window are read further: those of the span of
    ``minutes`` around a new step and of the spans beside it.
    """
    def span(moves: list[int]):
        return F.explode(F.array(*(F.floor(F.unix_seconds("ts") / (60 * minutes)) + move for move in moves))).alias("span")

    def same(left, right, *columns):
        return [left[c].eqNullSafe(right[c]) for c in columns]

    near = new.select("city_zone", span([-1, 0, 1])).distinct()
    spans = steps.select("*", span([0]))
    wanted = spans.join(near, same(spans, near, "city_zone", "span"), "left_semi")
    summed = wanted.groupBy("city_zone", F.window("ts", f"{slide_minutes} minutes").alias("step")).agg(
        F.sum("readings").alias("readings"), F.sum("pm25_sum").alias("pm25_sum"),
        F.sum("pm25_count").alias("pm25_count"), F.max("max_pm25").alias("max_pm25"),
    )
    windows = combine_steps(summed, minutes, slide_minutes)
    starts = F.expr(f"transform(sequence(0, {minutes - slide_minutes}, {slide_minutes}), m -> ts - make_dt_interval(0, 0, m))")
    touched = new.select("city_zone", F.explode(starts).alias("window_start")).distinct()
    return windows.join(touched, same(windows, touched, "city_zone", "window_start"), "left_semi")


def process_zone_batch(
    store: Store, batch: DataFrame, batch_id: int, *, lateness: dt.timedelta = dt.timedelta(minutes=2),
    minutes: int = 60, slide_minutes: int = 1,
) -> None:
    """Add a batch to the stored steps, then bring the windows it touches up to date, then log it.

    Each of these can be repeated: a lost run is made good by the next try of the same batch.
    """
    if minutes % slide_minutes:
        raise ValueError("a window must be a whole number of slides")
    located = batch.join(store.stations().select("station_id", "city_zone"), "station_id")
    store.append_zone_steps(zone_steps(located.select("city_zone", "ts", "pm25"), slide_minutes), batch_id)
    new = store.zone_steps_of_batch(batch_id)
    margin = f"make_dt_interval(0, 0, {minutes})"
    days = new.select(
        F.explode(F.expr(f"sequence(to_date(ts - {margin}), to_date(ts + {margin}), interval 1 day)")).alias("day")
    ).select(F.date_format("day", "yyyyMMdd").cast("int").alias("day")).distinct()
    days = [row["day"] for row in days.collect()]
    if days:
        store.upsert_zone_windows(corrected_windows(store.zone_steps(days), new, minutes, slide_minutes))
    store.append_zone_log(located.select("ts"), batch_id, lateness)


def run_zone_stream(
    spark: SparkSession, readings: DataFrame, store: Store, *, trigger: dict | None = None,
    lateness: dt.timedelta = dt.timedelta(minutes=2), minutes: int = 60, slide_minutes: int = 1,
    compact_every: int | None = FAN,
) -> StreamingQuery:
    """Keep ``store.zone_windows()`` equal to ``zone_windows`` over all readings that have come, however late.

    A batch is reduced to one row per zone and step before it is stored, and only windows that contain
    such a step are computed again. ``lateness`` drops nothing: ``store.zone_log()`` counts the readings that came
    later than this behind the newest one of the batches before. A store holds windows of one length and slide.
    Readings without a time or of unknown stations are in no window.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        process_zone_batch(store, batch, batch_id, lateness=lateness, minutes=minutes, slide_minutes=slide_minutes)
        # Only the last batch is ever repeated.
        if compact_every and batch_id and batch_id % compact_every == 0:
            store.compact_zone_steps(batch_id, fan=compact_every)

    return (
        readings.writeStream.foreachBatch(handle)
        .option("checkpointLocation", store.path("_checkpoints/zones"))
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
