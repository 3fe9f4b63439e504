"""Canonical table schemas, enumerations and declared limits."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
}


def fields(text: str) -> T.StructType:
    """A schema from ``name type [not null], ...``; unlike a DDL schema it needs no running session."""
    schema = T.StructType()
    for part in text.split(","):
        name, kind, *not_null = part.split()
        schema.add(name, _TYPES[kind], not not_null)
    return schema


READINGS = fields(
    "record_id bigint not null, station_id bigint not null, sensor_id bigint, ts timestamp not null,"
    " pm25 double, co2_ppm double, pm10 double, no2_ppm double, o3_ppm double,"
    " temperature_c double, humidity double, wind_speed double, wind_direction double,"
    " atmospheric_pressure double, status string, data_quality_score double, aqi_bucket string"
)
STATIONS = fields(
    "station_id bigint not null, station_name string, city_zone string not null,"
    " latitude double, longitude double, is_active boolean, status string"
)
SENSORS = fields(
    "sensor_id bigint not null, station_id bigint not null, sensor_type string, status string"
)
ALERTS = fields(
    "alert_id bigint, record_id bigint not null, station_id bigint not null, alert_type string,"
    " severity string, status string, message string, anomaly_score double,"
    " detection_method string, created_at timestamp"
)
PREDICTIONS = fields(
    "record_id bigint not null, station_id bigint, aqi_pred string, proba_good double,"
    " proba_moderate double, proba_unhealthy double, proba_hazardous double,"
    " confidence_score double, model_version string, predicted_at timestamp"
)
SYSTEM_METRICS = fields(
    "metric_id bigint, metric_name string, metric_value double, metric_unit string,"
    " recorded_at timestamp"
)

# Enumerations, in their declared order.
SEVERITIES = ["Low", "Moderate", "High", "Critical"]
SENSOR_STATUSES = ["Active", "Inactive", "Maintenance", "Offline"]
ALERT_STATUSES = ["Open", "Acknowledged", "Resolved", "Escalated"]
AQI_LABELS = ["Good", "Moderate", "Unhealthy", "Hazardous"]

# Declared precision of the stored measurements.
DECIMALS = {
    "co2_ppm": (10, 2),
    "pm25": (10, 2),
    "pm10": (10, 2),
    "no2_ppm": (8, 3),
    "o3_ppm": (8, 3),
    "temperature_c": (5, 2),
    "humidity": (5, 2),
    "wind_speed": (5, 2),
    "wind_direction": (5, 2),
    "atmospheric_pressure": (7, 2),
    "data_quality_score": (3, 2),
}

# Declared ranges (lower, upper); None is unbounded.
RANGES = {
    "co2_ppm": (0, None),
    "pm25": (0, None),
    "pm10": (0, None),
    "no2_ppm": (0, None),
    "o3_ppm": (0, None),
    "humidity": (0, 100),
    "wind_speed": (0, None),
    "wind_direction": (0, 360),
    "atmospheric_pressure": (0, None),
    "data_quality_score": (0, 1),
}

# Declared text lengths.
LENGTHS = {
    "status": 20, "station_name": 100, "city_zone": 100, "sensor_type": 50, "alert_type": 50,
    "detection_method": 50, "model_version": 20, "metric_name": 100, "metric_unit": 20,
}

# Columns of the older table layout and their canonical names.
RENAMED = {
    "reading_id": "record_id",
    "timestamp": "ts",
    "humidity_percent": "humidity",
    "wind_speed_ms": "wind_speed",
}

# Fixed values. A DEFAULT fills a column that a writer leaves out; an explicit NULL stays NULL.
DEFAULTS = {"status": "Normal", "data_quality_score": 1.0}

# Feature sets of the detectors and classifiers.
MONITOR_FEATURES = [
    "co2_ppm", "pm25", "pm10", "no2_ppm", "o3_ppm",
    "temperature_c", "humidity", "wind_speed", "atmospheric_pressure",
]
TRAINING_FEATURES = MONITOR_FEATURES[:8]
FOREST_FEATURES = ["co2_ppm", "pm25", "pm10", "temperature_c", "humidity"]
STREAM_FEATURES = ["pm25", "co2_ppm", "temperature_c", "humidity", "wind_speed"]
DERIVED_FEATURES = ["pm_ratio", "temp_humidity", "pollution_index"]
