"""Dashboard joins.

Newest-N results and dimension tables are sent to all tasks if Spark's own size check allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def newest_readings(df: DataFrame, limit: int) -> DataFrame:
    """Top-N by time; the key breaks ties."""
    return df.orderBy(F.desc("ts"), F.desc("record_id")).limit(limit)


def newest_alerts(df: DataFrame, limit: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_first("created_at"), F.desc("alert_id")).limit(limit)


def with_predictions(
    df: DataFrame, newest: DataFrame, predictions: DataFrame, columns: list[str]
) -> DataFrame:
    """Left join of ``df`` to the predictions, where all its keys occur in the bounded ``newest``.

    A left join cannot send its left side to the tasks, and would shuffle all predictions for a few
    rows. So the bounded keys first cut the predictions down where they are read.
    """
    matching = predictions.select("record_id", *columns).join(
        newest.select("record_id"), "record_id", "left_semi"
    )
    return df.join(matching, "record_id", "left")


def dashboard_readings(
    window: DataFrame, stations: DataFrame, predictions: DataFrame, limit: int = 1000
) -> DataFrame:
    """Newest ``limit`` readings, then their station and prediction.

    The limit comes before the inner join, so the result can hold fewer rows.
    """
    places = stations.select("station_id", "city_zone", "latitude", "longitude")
    top = newest_readings(
        window.select("record_id", "station_id", "ts", "pm25", "co2_ppm", "temperature_c", "humidity", "wind_speed"),
        limit,
    )
    joined = with_predictions(top.join(places, "station_id"), top, predictions, ["aqi_pred"])
    return newest_readings(joined, limit).select(
        "record_id", "station_id", "ts", "pm25", "co2_ppm", "temperature_c", "humidity", "wind_speed",
        "city_zone", "latitude", "longitude", "aqi_pred",
    )


PREDICTION_COLUMNS = [
    "aqi_pred", "proba_good", "proba_moderate", "proba_unhealthy", "proba_hazardous",
    "confidence_score", "model_version",
]


def dashboard_readings_full(
    window: DataFrame, stations: DataFrame, predictions: DataFrame, limit: int = 5000
) -> DataFrame:
    """Join first, limit last, with probabilities and model version.

    A left join keeps every left row, so the first ``limit`` joined rows come from the first
    ``limit`` located readings: the limit is applied before and again after that join.
    """
    station_columns = [c for c in stations.columns if c not in window.columns or c == "station_id"]
    top = newest_readings(window.join(stations.select(*station_columns), "station_id"), limit)
    joined = with_predictions(top, top, predictions, PREDICTION_COLUMNS)
    return newest_readings(joined, limit)


def alerts_with_station(alerts: DataFrame, stations: DataFrame, limit: int = 200) -> DataFrame:
    """Newest alerts that have a station."""
    places = stations.select("station_id", "city_zone", "latitude", "longitude")
    return newest_alerts(alerts.join(places, "station_id"), limit)


def active_sensors(stations: DataFrame, sensors: DataFrame) -> DataFrame:
    """Sensors in use at stations in use, ordered by ids."""
    return (
        sensors.where(F.col("status") == "Active")
        .join(stations.where("is_active").select("station_id"), "station_id")
        .select("station_id", "sensor_id", "sensor_type")
        .orderBy("station_id", "sensor_id")
    )


def reading_lineage(
    window: DataFrame, stations: DataFrame, sensors: DataFrame, predictions: DataFrame, alerts: DataFrame
) -> DataFrame:
    """Readings with station, sensor, prediction and alerts, one row per alert.

    Predictions and alerts share the join key ``record_id``, so one shuffle of the readings serves both.
    """
    return (
        window.select("record_id", "station_id", "sensor_id", "pm25", "ts")
        .join(stations.select("station_id", "station_name", "city_zone"), "station_id")
        .join(sensors.select("sensor_id", "sensor_type"), "sensor_id")
        .join(predictions.select("record_id", "aqi_pred"), "record_id", "left")
        .join(alerts.select("record_id", "alert_type", "severity"), "record_id", "left")
        .select(
            "record_id", "station_name", "city_zone", "sensor_type", "pm25", "ts", "aqi_pred",
            "alert_type", "severity",
        )
        .orderBy(F.desc("ts"), F.desc("record_id"), "alert_type")
    )
