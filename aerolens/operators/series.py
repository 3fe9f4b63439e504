"""Latest rows, top-k and series."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aerolens.operators.keyed import first_per_key, newest_metrics_order


def latest_per_station(readings: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """Last reading of each station; stations without coordinates are dropped afterwards.

    ``stations`` adds the coordinates where the readings lack them. That join comes last, when only one
    row per station is left.
    """
    latest = first_per_key(readings, ["station_id"], [F.desc("ts"), F.desc("record_id")])
    if stations is not None:
        places = stations.select("station_id", "city_zone", "latitude", "longitude")
        latest = latest.join(places, "station_id")
    return latest.dropna(subset=["latitude", "longitude"])


def recent_metrics(metrics: DataFrame, limit: int = 100) -> DataFrame:
    return metrics.orderBy(*newest_metrics_order()).limit(limit)


def metric_series(metrics: DataFrame, limit: int = 100, names: int = 6) -> DataFrame:
    """Time series of the metrics that show up first among the newest rows.

    The first ``names`` metric names are taken before names with a single point are dropped.
    """
    newest = recent_metrics(metrics, limit)
    chosen = (
        newest.groupBy("metric_name")
        .agg(
            F.expr("max(struct(recorded_at is null, recorded_at, metric_id)) as newest"),
            F.expr("count(*) as points"),
        )
        .orderBy(F.desc("newest"))
        .limit(names)
        .where("points > 1")
    )
    return newest.join(F.broadcast(chosen.select("metric_name")), "metric_name", "left_semi").orderBy(
        "metric_name", "recorded_at", "metric_id"
    )


def named_metric_series(metrics: DataFrame, names: list[str], limit: int = 300) -> DataFrame:
    """Series of fixed metric names among the newest rows."""
    return recent_metrics(metrics, limit).where(F.col("metric_name").isin(names)).orderBy(
        "metric_name", "recorded_at", "metric_id"
    )


def zone_series(df: DataFrame) -> DataFrame:
    """PM2.5 by zone over time; the sort is ranged by zone, time and key, so a large zone is split."""
    return df.select("city_zone", "ts", "pm25", "record_id").orderBy("city_zone", "ts", "record_id")


def zone_windows(df: DataFrame, minutes: int = 60, slide_minutes: int = 1) -> DataFrame:
    """Sliding averages per zone, each window a whole number of slides.

    Rows are first reduced to one per zone and slide step; only these few rows are copied into the
    windows that contain them, instead of every reading once per window.
    """
    if minutes % slide_minutes:
        raise ValueError("a window must be a whole number of slides")
    steps = df.groupBy("city_zone", F.window("ts", f"{slide_minutes} minutes").alias("step")).agg(
        F.expr("count(*) as readings"),
        F.expr("sum(pm25) as pm25_sum"),
        F.expr("count(pm25) as pm25_count"),
        F.expr("max(pm25) as max_pm25"),
    )
    return combine_steps(steps, minutes, slide_minutes)


def combine_steps(steps: DataFrame, minutes: int, slide_minutes: int) -> DataFrame:
    """Merge step aggregates into sliding windows; works on batch and streaming frames."""
    sliding = F.window("step_time", f"{minutes} minutes", f"{slide_minutes} minutes")
    return (
        steps.withColumn("step_time", F.window_time("step"))
        .groupBy("city_zone", sliding.alias("window"))
        .agg(
            F.expr("sum(readings) as readings"),
            F.expr("try_divide(sum(pm25_sum), sum(pm25_count)) as avg_pm25"),
            F.expr("max(max_pm25) as max_pm25"),
        )
        .selectExpr(
            "window.start as window_start", "window.end as window_end", "city_zone", "readings",
            "avg_pm25", "max_pm25",
        )
    )
