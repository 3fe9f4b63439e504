"""Alert rules. Every alert carries the key of its reading."""

from __future__ import annotations

from pyspark.sql import DataFrame

from aerolens.functions.ladders import above, anomaly_severity
from aerolens.functions.text import fixed_decimals

ALERT_COLUMNS = [
    "record_id", "station_id", "alert_type", "severity", "message", "anomaly_score",
    "detection_method", "created_at",
]

# The thresholds, scores and message texts of all rules below.
PM25 = fixed_decimals("pm25", 1)
CO2 = fixed_decimals("co2_ppm", 0)
TEMPERATURE = fixed_decimals("temperature_c", 1)


def anomaly_alerts(flagged: DataFrame) -> DataFrame:
    """Alerts of the monitor from ``is_statistical_outlier`` and ``is_isolation_outlier``."""
    return flagged.where("is_statistical_outlier or is_isolation_outlier").selectExpr(
        "record_id",
        "station_id",
        "'Anomaly' as alert_type",
        f"{anomaly_severity()} as severity",
        f"""concat('Anomaly detected at station ', station_id, ': PM2.5=', {PM25}, 'μg/m³, CO2=', {CO2},
              'ppm, Temp=', {TEMPERATURE}, '°C') as message""",
        """round(least(1.0D, if(is_isolation_outlier, 0.8D, 0.6D) + if(is_statistical_outlier, 0.2D, 0.0D)), 3)
              as anomaly_score""",
        """concat_ws('|', if(is_statistical_outlier, 'Statistical', null),
              if(is_isolation_outlier, 'IsolationForest', null)) as detection_method""",
        "ts as created_at",
    )


def anomaly_alerts_simple(flagged: DataFrame) -> DataFrame:
    """Alerts of the forest alone, from ``is_outlier``."""
    return flagged.where("is_outlier").selectExpr(
        "record_id",
        "station_id",
        "'Anomaly' as alert_type",
        f"if({above(100, 800)}, 'Critical', 'High') as severity",
        f"concat('Anomaly detected: PM2.5=', {PM25}, ', CO2=', {CO2}, 'ppm') as message",
        "0.8D as anomaly_score",
        "'IsolationForest' as detection_method",
        "ts as created_at",
    )


def batch_outlier_alerts(flagged: DataFrame) -> DataFrame:
    """Alerts for the rows a batch detector marked ``is_anomaly``; they carry its score."""
    return flagged.where("is_anomaly").selectExpr(
        "record_id",
        "station_id",
        "'Outlier Detected' as alert_type",
        "if(anomaly_score > 5, 'High', 'Moderate') as severity",
        f"concat('Anomaly: PM2.5=', {PM25}, ', CO₂=', {CO2}, ' ppm') as message",
        "anomaly_score",
        "'BatchOutlier' as detection_method",
        "ts as created_at",
    )


def threshold_alerts(df: DataFrame) -> DataFrame:
    """None to two alerts per reading: one of the PM2.5 steps, and independently CO2."""

    def alert(kind: str, severity: str, message: str, score: str) -> str:
        return (
            f"named_struct('alert_type', '{kind}', 'severity', '{severity}',"
            f" 'message', {message}, 'anomaly_score', {score})"
        )

    pm25_message = f"concat('PM2.5 ', {PM25}, ' µg/m³')"
    co2_message = f"concat('CO₂ ', {CO2}, ' ppm')"
    raised = f"""array(
        case when pm25 > 100 then {alert("High PM2.5", "Critical", pm25_message, "pm25 / 100")}
             when pm25 > 55 then {alert("PM2.5 Alert", "High", pm25_message, "pm25 / 100")} end,
        case when co2_ppm > 800 then {alert("CO₂ Alert", "Moderate", co2_message, "co2_ppm / 1000")} end)"""
    # Most readings raise nothing; they leave before alerts are built and unnested.
    return df.where("pm25 > 55 or co2_ppm > 800").selectExpr(
        "record_id",
        "station_id",
        f"inline(array_compact({raised}))",
        "'Threshold' as detection_method",
        "ts as created_at",
    )


def pm25_high_alerts(df: DataFrame) -> DataFrame:
    """Open alert for each PM2.5 value over 50."""
    return df.where("pm25 > 50").selectExpr(
        "record_id",
        "station_id",
        "'PM2.5 High' as alert_type",
        "case when pm25 > 100 then 'Critical' when pm25 > 75 then 'High' else 'Moderate' end as severity",
        "'Open' as status",
        f"concat('PM2.5 level ', {PM25}, ' μg/m³ exceeds safe threshold') as message",
        "ts as created_at",
    )
