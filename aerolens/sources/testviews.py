"""The canonical tables as views over the shared Parquet test tables.

``events`` supplies the readings and ``customer`` the stations; see FIXTURES.md. The same
views in DuckDB SQL are ``SQL_VIEWS``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolens.functions.ladders import aqi_bucket
from aerolens.operators.alerts import threshold_alerts
from aerolens.schema import AQI_LABELS
from aerolens.session import configure

EVENTS = "event_id bigint, user_id bigint, event_type string, ts timestamp, value double, props string"
CUSTOMER = "c_custkey bigint, c_name string, c_mktsegment string"

# Sensor position within a station, by sensor type.
SENSOR_TYPES = "array('click', 'error', 'purchase', 'signup', 'view')"


class TestTables:
    """Lazy canonical tables over one scale-factor folder."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def _read(self, name: str, ddl: str) -> DataFrame:
        # A declared schema reads ``ts`` as TIMESTAMP (what watermarks need) and skips inference.
        return self.spark.read.schema(ddl).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self._read("events", EVENTS)

    @cached_property
    def readings(self) -> DataFrame:
        return readings_from_events(self.events)

    @cached_property
    def stations(self) -> DataFrame:
        return self._read("customer", CUSTOMER).selectExpr(
            "c_custkey as station_id",
            "c_name as station_name",
            "c_mktsegment as city_zone",
            "case when c_custkey % 7 <> 0 then cast(40000 + c_custkey % 1000 as double) / 1000 end as latitude",
            "cast(-74000 + c_custkey % 1000 as double) / 1000 as longitude",
            "c_custkey % 10 <> 0 as is_active",
        )

    @cached_property
    def sensors(self) -> DataFrame:
        positioned = self._read("customer", CUSTOMER).selectExpr(
            "c_custkey as station_id", f"posexplode({SENSOR_TYPES}) as (i, sensor_type)"
        )
        return positioned.selectExpr(
            "station_id * 5 + i as sensor_id",
            "station_id",
            "sensor_type",
            "case when (station_id + i) % 11 = 0 then 'Maintenance' else 'Active' end as status",
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """The rule label of every reading with a PM2.5 value, with all weight on that label."""
        labelled = self.readings.where("pm25 is not null").withColumn("aqi_pred", F.expr(aqi_bucket()))
        return labelled.selectExpr(
            "record_id",
            "station_id",
            "aqi_pred",
            *[f"cast(aqi_pred = '{name}' as double) as proba_{name.lower()}" for name in AQI_LABELS],
            "1.0D as confidence_score",
            "'rule' as model_version",
            "ts as predicted_at",
        )

    @cached_property
    def alerts(self) -> DataFrame:
        return threshold_alerts(self.readings).selectExpr(
            "record_id * 2 + cast(alert_type = 'CO₂ Alert' as bigint) as alert_id",
            "record_id", "station_id", "alert_type", "severity",
            "case when record_id % 4 = 0 then 'Resolved' else 'Open' end as status",
            "message", "anomaly_score", "detection_method", "created_at",
        )

    @cached_property
    def system_metrics(self) -> DataFrame:
        """Three metrics per day: average and maximum PM2.5 and the number of readings."""
        per_day = self.readings.selectExpr("date_trunc('day', ts) as recorded_at", "pm25").groupBy("recorded_at").agg(
            F.expr("avg(pm25) as avg_pm25"),
            F.expr("max(pm25) as max_pm25"),
            F.expr("cast(count(*) as double) as reading_count"),
        )
        return per_day.selectExpr(
            "recorded_at",
            """stack(3, 0, 'avg_pm25', avg_pm25, 'µg/m³', 1, 'max_pm25', max_pm25, 'µg/m³',
                 2, 'reading_count', reading_count, 'count') as (i, metric_name, metric_value, metric_unit)""",
        ).selectExpr(
            "unix_date(to_date(recorded_at)) * 3L + i as metric_id",
            "metric_name", "metric_value", "metric_unit", "recorded_at",
        )


def readings_from_events(events: DataFrame) -> DataFrame:
    """Readings from an events frame, batch or streaming."""
    k = "cast(get_json_object(props, '$.k') as int)"
    return events.selectExpr(
        "event_id as record_id",
        "user_id as station_id",
        f"case when event_type is not null then user_id * 5 + array_position({SENSOR_TYPES}, event_type) - 1 end as sensor_id",
        "event_type as sensor_type",
        "ts",
        "case when event_type <> 'signup' then value end as pm25",
        f"case when event_type <> 'view' then cast(400 + 5 * {k} as double) end as co2_ppm",
        "case when event_id % 13 <> 0 then value * 1.2D end as pm10",
        "cast(10 + event_id % 9 as double) / 1000 as no2_ppm",
        "cast(20 + event_id % 7 as double) / 1000 as o3_ppm",
        "case when event_id % 17 <> 0 then cast(20 + event_id % 29 as double) / 2 end as temperature_c",
        "cast(40 + (event_id * 7) % 31 as double) as humidity",
        "cast((event_id * 3) % 41 as double) / 4 as wind_speed",
        "cast((event_id * 37) % 360 as double) as wind_direction",
        "cast(1000 + event_id % 27 as double) as atmospheric_pressure",
        "cast(50 + event_id % 51 as double) / 100 as data_quality_score",
    )


# The same views as DuckDB common table expressions, in dependency order.
SQL_VIEWS = {
    "readings": """
      select event_id as record_id, user_id as station_id,
        user_id*5 + list_position(['click','error','purchase','signup','view'], event_type) - 1 as sensor_id,
        event_type as sensor_type, cast(ts as timestamp) as ts,
        case when event_type='signup' then null else value end as pm25,
        case when event_type='view' then null else cast(400 + 5*k as double) end as co2_ppm,
        case when event_id % 13 = 0 then null else value*cast(1.2 as double) end as pm10,
        cast(10 + event_id % 9 as double)/1000 as no2_ppm,
        cast(20 + event_id % 7 as double)/1000 as o3_ppm,
        case when event_id % 17 = 0 then null else cast(20 + event_id % 29 as double)/2 end as temperature_c,
        cast(40 + (event_id*7) % 31 as double) as humidity,
        cast((event_id*3) % 41 as double)/4 as wind_speed,
        cast((event_id*37) % 360 as double) as wind_direction,
        cast(1000 + event_id % 27 as double) as atmospheric_pressure,
        cast(50 + event_id % 51 as double)/100 as data_quality_score
      from (select *, cast(json_extract_string(props,'$.k') as int) as k from events) e""",
    "stations": """
      select c_custkey as station_id, c_name as station_name, c_mktsegment as city_zone,
        case when c_custkey % 7 = 0 then null else cast(40000 + c_custkey % 1000 as double)/1000 end as latitude,
        cast(-74000 + c_custkey % 1000 as double)/1000 as longitude,
        c_custkey % 10 <> 0 as is_active
      from customer""",
    "sensors": """
      select c_custkey*5 + i as sensor_id, c_custkey as station_id, sensor_type,
        case when (c_custkey + i) % 11 = 0 then 'Maintenance' else 'Active' end as status
      from customer cross join
        (values (0,'click'),(1,'error'),(2,'purchase'),(3,'signup'),(4,'view')) t(i, sensor_type)""",
    "labelled": """
      select *, case when pm25 is null then null when pm25 <= 12 then 'Good' when pm25 <= 35 then 'Moderate'
                     when pm25 <= 55 then 'Unhealthy' else 'Hazardous' end as aqi_bucket
      from readings""",
    "predictions": """
      select record_id, station_id, aqi_bucket as aqi_pred,
        cast(aqi_bucket='Good' as double) as proba_good, cast(aqi_bucket='Moderate' as double) as proba_moderate,
        cast(aqi_bucket='Unhealthy' as double) as proba_unhealthy,
        cast(aqi_bucket='Hazardous' as double) as proba_hazardous,
        cast(1 as double) as confidence_score, 'rule' as model_version, ts as predicted_at
      from labelled where pm25 is not null""",
    "threshold": """
      select record_id, station_id, case when pm25 > 100 then 'High PM2.5' else 'PM2.5 Alert' end as alert_type,
        case when pm25 > 100 then 'Critical' else 'High' end as severity,
        'PM2.5 ' || cast(round(cast(pm25 as decimal(20,2)),1) as varchar) || ' µg/m³' as message,
        pm25/100 as anomaly_score, 'Threshold' as detection_method, ts as created_at
      from readings where pm25 > 55
      union all
      select record_id, station_id, 'CO₂ Alert', 'Moderate',
        'CO₂ ' || cast(round(cast(co2_ppm as decimal(20,2)),0) as varchar) || ' ppm',
        co2_ppm/1000, 'Threshold', ts
      from readings where co2_ppm > 800""",
    "alerts": """
      select record_id*2 + case when alert_type='CO₂ Alert' then 1 else 0 end as alert_id,
        record_id, station_id, alert_type, severity,
        case when record_id % 4 = 0 then 'Resolved' else 'Open' end as status,
        message, anomaly_score, detection_method, created_at
      from threshold""",
    "system_metrics": """
      select (cast(d as date) - date '1970-01-01')*3 + i as metric_id, metric_name,
        case i when 0 then a when 1 then m else n end as metric_value, metric_unit, d as recorded_at
      from (select date_trunc('day', ts) as d, avg(pm25) as a, max(pm25) as m, cast(count(*) as double) as n
            from readings group by 1) per_day
      cross join (values (0,'avg_pm25','µg/m³'),(1,'max_pm25','µg/m³'),(2,'reading_count','count'))
        t(i, metric_name, metric_unit)""",
    "w": """
      select * from labelled
      where ts >= (select max(ts) from readings) - interval '7' day
        and data_quality_score > cast(0.7 as double) and pm25 is not null and co2_ppm is not null""",
}

_NEEDS = {
    "labelled": ["readings"], "predictions": ["labelled"], "threshold": ["readings"],
    "alerts": ["threshold"], "system_metrics": ["readings"], "w": ["labelled"],
}


def with_views(body: str, *views: str) -> str:
    """Prefix a DuckDB query with the views it names and those these need."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        wanted.add(name)

    for view in views:
        add(view)
    parts = [f"{name} as ({text.strip()})" for name, text in SQL_VIEWS.items() if name in wanted]
    return "with " + ",\n".join(parts) + "\n" + body.strip()
