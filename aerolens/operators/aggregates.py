"""Key figures, counts and metric rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from aerolens.functions.ladders import traffic_light
from aerolens.operators.filters import open_alerts, recent
from aerolens.schema import SEVERITIES


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, sorted by name."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def kpi_summary(readings: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row of key figures; on no rows the averages are NULL and the counts zero."""
    return readings.agg(
        F.expr("avg(pm25) as avg_pm25"),
        F.expr("avg(co2_ppm) as avg_co2"),
        F.expr("max(pm25) as max_pm25"),
        F.expr("count(*) as total_records"),
    ).withColumn("active_alerts", _rows(open_alerts(alerts)))


def _rows(df: DataFrame):
    """The number of rows, as a scalar subquery."""
    return df.agg(F.expr("count(*)")).scalar()


def kpi_bands(summary: DataFrame) -> DataFrame:
    """Traffic light per key figure."""
    # Upper and middle limits.
    limits = {"avg_pm25": (35, 12), "avg_co2": (600, 500), "max_pm25": (100, 55), "active_alerts": (10, 0)}
    return summary.selectExpr(
        *[f"{traffic_light(name, high, mid)} as {name}_band" for name, (high, mid) in limits.items()]
    )


def kpi_overview(readings: DataFrame, stations: DataFrame, alerts: DataFrame) -> DataFrame:
    """Active stations, latest PM2.5, open alerts and average temperature."""
    return readings.agg(
        F.expr("max_by(pm25, struct(ts, record_id)) filter (where pm25 is not null) as latest_pm25"),
        F.expr("avg(temperature_c) as avg_temperature"),
    ).withColumns(
        {"active_stations": _rows(stations.where("is_active")), "open_alerts": _rows(open_alerts(alerts))}
    )


def severity_counts(alerts: DataFrame) -> DataFrame:
    """Open alerts per severity, all four levels; one aggregate row is turned on its side."""
    counted = open_alerts(alerts).agg(
        *[F.expr(f"count_if(severity = '{name}') as {name}") for name in SEVERITIES]
    )
    return counted.unpivot([], SEVERITIES, "severity", "open_alerts")


def recent_prediction_count(predictions: DataFrame, as_of=None, minutes: int = 5) -> DataFrame:
    """Predictions made in the last minutes."""
    return recent(predictions, minutes, as_of, "predicted_at").agg(F.expr("count(*) as predictions"))


def model_accuracy(df: DataFrame, predicted: str, label: str) -> DataFrame:
    """Share of rows whose prediction equals the label; rows without a label do not count."""
    return df.where(f"{label} is not null").agg(
        F.expr(f"avg(cast({predicted} = {label} as double)) as accuracy")
    )


def batch_metrics(
    batch: DataFrame, flagged: str = "is_anomaly", predicted: str = "aqi_pred", label: str = "aqi_bucket"
) -> DataFrame:
    """Average PM2.5, anomaly count and accuracy of a batch as name, value and unit."""
    figures = batch.agg(
        F.expr("avg(pm25) as avg_pm25_batch"),
        F.expr(f"count_if({flagged}) as anomaly_count"),
        F.expr(
            f"avg(coalesce(cast({predicted} = {label} as double), 0.0D)) filter (where {label} is not null)"
            " as stream_model_accuracy"
        ),
    )
    return metric_rows(
        figures, {"avg_pm25_batch": "µg/m³", "anomaly_count": "count", "stream_model_accuracy": "score"}
    )


def metric_rows(df: DataFrame, units: dict[str, str], *keep: str) -> DataFrame:
    """Turn metric columns into rows of name, value and unit."""
    parts = ", ".join(f"'{name}', cast({name} as double), '{unit}'" for name, unit in units.items())
    return df.selectExpr(
        *keep, f"stack({len(units)}, {parts}) as (metric_name, metric_value, metric_unit)"
    )


# The metrics a monitoring cycle reports, and their units.
CYCLE_UNITS = {
    "outliers_detected": "count",
    "predictions_generated": "count",
    "monitoring_cycle_time": "seconds",
    "total_cycles": "count",
    "avg_outliers_per_cycle": "count",
    "avg_predictions_per_cycle": "count",
}


def cycle_metrics(log: DataFrame) -> DataFrame:
    """Metric rows of each cycle in a log ``run_id, cycle, outliers, predictions, seconds``.

    Totals run over the cycles of one monitor run.
    """
    sofar = "over (partition by run_id order by cycle rows unbounded preceding)"
    totals = log.selectExpr(
        "run_id",
        "cycle",
        "outliers as outliers_detected",
        "predictions as predictions_generated",
        "seconds as monitoring_cycle_time",
        f"count(*) {sofar} as total_cycles",
        f"avg(outliers) {sofar} as avg_outliers_per_cycle",
        f"avg(predictions) {sofar} as avg_predictions_per_cycle",
    )
    return metric_rows(totals, CYCLE_UNITS, "run_id", "cycle")


def station_statistics(stations: DataFrame, sensors: DataFrame, readings: DataFrame) -> DataFrame:
    """Per station: sensors, last reading and average PM2.5.

    Both sides are reduced to one row per station before they meet, so nothing counts twice.
    """
    sensor_counts = sensors.groupBy("station_id").agg(F.expr("count(*) as sensors"))
    levels = readings.groupBy("station_id").agg(
        F.expr("max(ts) as last_reading"), F.expr("avg(pm25) as avg_pm25"), F.expr("count(*) as readings")
    )
    return (
        stations.join(sensor_counts, "station_id", "left")
        .join(levels, "station_id", "left")
        .selectExpr(
            "station_id", "station_name", "city_zone", "coalesce(sensors, 0L) as sensor_count",
            "last_reading", "avg_pm25", "coalesce(readings, 0L) as reading_count",
        )
    )


def sensors_needing_attention(readings: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Sensors whose average data quality is below the threshold."""
    return (
        readings.where("sensor_id is not null")
        .groupBy("sensor_id")
        .agg(F.expr("avg(data_quality_score) as avg_quality"), F.expr("count(*) as readings"))
        .where(f"avg_quality < {threshold}D")
    )
