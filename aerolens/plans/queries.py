"""Every operator as a runnable query over the test tables, next to the DuckDB SQL it must equal.

Averages and scores are rounded on both sides; times are given without a zone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from aerolens.functions import ladders
from aerolens.operators import aggregates, alerts, derive, filters, forest, joins, keyed, model, outliers, quality, series
from aerolens.operators.statistics import impute_median
from aerolens.plans.monitor import detect_anomalies, run_cycle
from aerolens.plans.deletes import delete_stations
from aerolens.plans.history import history_lineage, write_history
from aerolens.plans.store import STORED_PREDICTIONS, Store
from aerolens.plans.training import train_full_model
from aerolens.schema import (
    AQI_LABELS, FOREST_FEATURES, MONITOR_FEATURES, READINGS, SENSOR_STATUSES, SEVERITIES, STREAM_FEATURES,
    TRAINING_FEATURES,
)
from aerolens.session import materialized, scratch_path
from aerolens.sources.tables import (
    BULK, append_readings, partition_column, read_table, scan_readings, stream_readings, upsert_partitions,
    with_partition, write_partitioned,
)
from aerolens.sources.testviews import EVENTS, TestTables, readings_from_events, with_views
from aerolens.streaming.ingest import KeptForests, admit_batch, run_ingest_stream
from aerolens.streaming.zones import run_zone_stream, stream_zone_windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
WEEK = 7 * 24 * 60
SINCE_WEEK = "ts >= (select max(ts) from readings) - interval '7' day"


def query(sql: str | None = None, views: str = "readings"):
    """Register a function of the test tables under its own name."""

    def register(function: Callable[[TestTables], DataFrame]):
        name = function.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_times(function(TestTables(spark, sf_dir)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(sql, *views.split())
        return function

    return register


def plain_times(df: DataFrame) -> DataFrame:
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def week(t: TestTables) -> DataFrame:
    """Readings of the last seven days with their AQI class."""
    return filters.recent(derive.with_aqi_bucket(t.readings), WEEK)


def gated_week(t: TestTables) -> DataFrame:
    return filters.quality_gate(week(t))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.expr(f"round({c}, {digits})") for c in columns})


# --- sources and sinks ------------------------------------------------------------------------


def stored_readings(t: TestTables, unit: str = "day") -> str:
    path = scratch_path(t.spark, "readings")
    write_partitioned(t.readings, path, unit=unit)
    return path


@query(
    f"""select record_id, station_id, ts, pm25, co2_ppm from readings where {SINCE_WEEK}"""
)
def scan_readings_query(t):
    return scan_readings(
        t.spark, stored_readings(t), minutes=WEEK,
        columns=["record_id", "station_id", "ts", "pm25", "co2_ppm"],
    )


@query(
    """select cast(strftime(ts, '%Y%m') as int) as ts_month, count(*) as n, count(pm25) as pm25_known,
         round(sum(pm25), 4) as pm25_sum, min(ts) as first_ts, max(ts) as last_ts, cast(sum(record_id) as bigint) as ids
       from readings group by 1"""
)
def write_partitioned_query(t):
    back = read_table(t.spark, stored_readings(t, "month"), t.readings.schema, "ts_month int", "batch_id bigint")
    back = back.where(F.col("batch_id") == BULK)
    return back.groupBy("ts_month").agg(
        F.expr("count(*) as n"), F.expr("count(pm25) as pm25_known"), F.expr("round(sum(pm25), 4) as pm25_sum"),
        F.expr("min(ts) as first_ts"), F.expr("max(ts) as last_ts"), F.expr("sum(record_id) as ids"),
    )


def streamed_events(t: TestTables) -> DataFrame:
    """The events file as a stream."""
    return t.spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)


def run_to_end(stream: DataFrame, target: str, mode: str = "append") -> None:
    """Drain a stream into a Parquet folder."""
    (
        stream.writeStream.format("parquet").outputMode(mode)
        .option("path", target).option("checkpointLocation", f"{target}/_checkpoints")
        .trigger(availableNow=True).start().awaitTermination()
    )


@query("""select record_id, station_id, ts, pm25, co2_ppm, temperature_c from readings""")
def stream_readings_query(t):
    landing, target = scratch_path(t.spark, "landing"), scratch_path(t.spark, "streamed")
    t.events.repartition(8).write.parquet(landing)
    stream = readings_from_events(stream_readings(t.spark, landing, EVENTS, files_per_batch=3))
    columns = ["record_id", "station_id", "ts", "pm25", "co2_ppm", "temperature_c"]
    run_to_end(stream.select(*columns), target)
    return t.spark.read.parquet(target)


@query("""select record_id, station_id, sensor_id, ts, pm25, co2_ppm, event_batch as batch_id
          from (select *, cast(record_id % 3 as bigint) as event_batch from readings)""")
def append_readings_query(t):
    path = scratch_path(t.spark, "appended")
    for batch_id in (0, 1, 2, 1):  # batch 1 comes twice, as after a restart
        append_readings(t.readings.where(F.col("record_id") % 3 == batch_id), path, batch_id)
    back = read_table(t.spark, path, t.readings.schema, "ts_day int", "batch_id bigint")
    return back.select("record_id", "station_id", "sensor_id", "ts", "pm25", "co2_ppm", "batch_id")


@query(
    """, existing as (select * from threshold where alert_type <> 'CO₂ Alert'),
       fresh as (select record_id, station_id, 'High PM2.5' as alert_type,
         case when pm25 > 100 then 'Critical' when pm25 > 75 then 'High' else 'Moderate' end as severity
         from readings where pm25 > 50)
       select record_id, station_id, alert_type, severity from existing
       union all
       select record_id, station_id, alert_type, severity from fresh f
       where not exists (select 1 from existing e where e.record_id = f.record_id and e.alert_type = f.alert_type)""",
    "threshold",
)
def insert_if_absent(t):
    columns = ["record_id", "station_id", "alert_type", "severity"]
    existing = alerts.threshold_alerts(t.readings).where(F.col("alert_type") != "CO₂ Alert").select(*columns)
    new = alerts.pm25_high_alerts(t.readings).withColumn("alert_type", F.lit("High PM2.5")).select(*columns)
    twice = new.unionByName(new)  # the batch itself repeats its keys
    return keyed.insert_if_absent(existing, twice, ["record_id", "alert_type"], [F.desc("severity")])


@query(
    f""", rescored as (select record_id, station_id, ts,
         case when pm25/2 <= 12 then 'Good' when pm25/2 <= 35 then 'Moderate' when pm25/2 <= 55 then 'Unhealthy'
              else 'Hazardous' end as aqi_pred
         from readings where pm25 is not null and {SINCE_WEEK})
       select record_id, station_id, aqi_pred, 'v2' as model_version from rescored
       union all
       select record_id, station_id, aqi_pred, model_version from predictions
       where record_id not in (select record_id from rescored)""",
    "predictions",
)
def upsert_predictions(t):
    path = scratch_path(t.spark, "predictions")
    columns = ["record_id", "station_id", "aqi_pred", "model_version", "predicted_at"]
    old = with_partition(t.predictions.select(*columns), "day", "predicted_at")
    day = partition_column("day")
    old.hint("rebalance", day).write.partitionBy(day).parquet(path)
    new = with_partition(
        filters.recent(t.readings, WEEK).where("pm25 is not null").selectExpr(
            "record_id", "station_id", f"{ladders.aqi_bucket('(pm25 / 2)')} as aqi_pred",
            "'v2' as model_version", "ts as predicted_at",
        ),
        "day", "predicted_at",
    )
    schema = T.StructType([f for f in old.schema.fields if f.name != day])
    upsert_partitions(t.spark, path, new, schema, ["record_id"], [F.desc("predicted_at")], day)
    return read_table(t.spark, path, schema, f"{day} int").select(*columns[:4])


@query(
    """select metric_id, metric_name, round(metric_value, 6) as metric_value, metric_unit, recorded_at
       from system_metrics order by recorded_at desc nulls first, metric_id desc limit 60""",
    "system_metrics",
)
def retain_latest_metrics(t):
    return rounded(keyed.retain_latest_metrics(t.system_metrics, 60), "metric_value")


@query(
    """select metric_id, metric_name from system_metrics
       where metric_id not in (select metric_id from system_metrics order by recorded_at desc, metric_id desc limit 60)""",
    "system_metrics",
)
def expired_metrics(t):
    return keyed.expired_metrics(t.system_metrics, 60).select("metric_id", "metric_name")


@query(
    """, gone as (select station_id from stations where not is_active)
       select 'stations' as table_name, count(*) as remaining, cast(sum(station_id) as bigint) as ids
         from stations where station_id not in (select * from gone)
       union all select 'sensors', count(*), cast(sum(sensor_id) as bigint) from sensors where station_id not in (select * from gone)
       union all select 'readings', count(*), cast(sum(record_id) as bigint) from readings where station_id not in (select * from gone)
       union all select 'alerts', count(*), cast(sum(alert_id) as bigint) from alerts where station_id not in (select * from gone)
       union all select 'predictions', count(*), cast(sum(record_id) as bigint) from predictions
         where station_id not in (select * from gone)""",
    "stations sensors readings alerts predictions",
)
def cascade_delete(t):
    left = keyed.cascade_delete(
        t.stations.where(~F.col("is_active")),
        {"stations": t.stations, "sensors": t.sensors, "readings": t.readings, "alerts": t.alerts,
         "predictions": t.predictions},
    )
    ids = {"stations": "station_id", "sensors": "sensor_id", "alerts": "alert_id"}
    frames = [
        df.agg(F.count(F.lit(1)).alias("remaining"), F.sum(ids.get(name, "record_id")).alias("ids"))
        .select(F.lit(name).alias("table_name"), "remaining", "ids")
        for name, df in left.items()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def store_of(t: TestTables) -> Store:
    """The test tables as stored ones; of the readings some in bulk, some put together, some as they came."""
    store = Store(t.spark, scratch_path(t.spark, "stored"), "day")
    readings = t.readings.withColumn("sensor_id", F.col("sensor_id").cast("bigint"))
    store.load_readings(readings.where("record_id % 3 = 0"))
    for batch_id in range(5):
        store.append_readings(readings.where(f"record_id % 3 > 0 and record_id % 5 = {batch_id}"), batch_id)
    store.compact(5, fan=2, grace=0)
    t.stations.withColumn("status", F.lit("Active")).write.parquet(store.path("stations"))
    t.sensors.write.parquet(store.path("sensors"))
    alerts_ = t.alerts.select(*alerts.ALERT_COLUMNS)
    store.append_alerts(alerts_.where("record_id % 2 = 0"), "ingest", 0)
    store.append_alerts(alerts_.where("record_id % 2 = 1"), "monitor", 7)
    timed = t.predictions.join(t.readings.select("record_id", "ts"), "record_id")
    known = set(timed.columns)
    full = timed.select(*(F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name) for f in STORED_PREDICTIONS.fields))
    full = full.join(t.readings.select("record_id", F.col("station_id").alias("_of")), "record_id").withColumn("station_id", F.col("_of"))
    store.upsert_predictions(full.where("record_id % 2 = 0").select(*STORED_PREDICTIONS.fieldNames()))
    store.append_predictions(full.where("record_id % 2 = 1"), 0)
    return store


@query(
    """, gone as (select station_id from stations where not is_active)
       select 'stations' as table_name, count(*) as remaining, cast(sum(station_id) as bigint) as ids
         from stations where station_id not in (select * from gone)
       union all select 'sensors', count(*), cast(sum(sensor_id) as bigint) from sensors where station_id not in (select * from gone)
       union all select 'readings', count(*), cast(sum(record_id) as bigint) from readings where station_id not in (select * from gone)
       union all select 'alerts', count(*), cast(sum(record_id) as bigint) from alerts where station_id not in (select * from gone)
       union all select 'predictions', count(*), cast(sum(record_id) as bigint) from predictions
         where station_id not in (select * from gone)""",
    "stations sensors readings alerts predictions",
)
def stored_cascade_delete(t):
    """What is left in the stored tables after the stations out of use were deleted from them."""
    store = store_of(t)
    delete_stations(store, store.stations().where(~F.col("is_active")))
    left = {
        "stations": (store.stations(), "station_id"), "sensors": (store.sensors(), "sensor_id"),
        "readings": (store.all_readings(), "record_id"), "alerts": (store.alerts(), "record_id"),
        "predictions": (store.predictions(), "record_id"),
    }
    frames = [
        df.agg(F.count(F.lit(1)).alias("remaining"), F.sum(key).alias("ids")).select(F.lit(name).alias("table_name"), "remaining", "ids")
        for name, (df, key) in left.items()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


@query(
    """select * from (
         select 'alerts' as table_name, count(*) as rows from alerts
         union all select 'predictions', count(*) from predictions
         union all select 'readings', count(*) from readings
         union all select 'sensors', count(*) from sensors
         union all select 'stations', count(*) from stations
         union all select 'system_metrics', count(*) from system_metrics) order by table_name""",
    "alerts predictions readings sensors stations system_metrics",
)
def table_profile(t):
    return aggregates.table_profile(
        {"stations": t.stations, "sensors": t.sensors, "readings": t.readings, "alerts": t.alerts,
         "predictions": t.predictions, "system_metrics": t.system_metrics}
    )


# --- conformance and data quality -------------------------------------------------------------


@query(
    """select record_id, station_id, ts, cast(cast(pm25 as decimal(10,2)) as double) as pm25,
         cast(cast(co2_ppm as decimal(10,2)) as double) as co2_ppm,
         cast(cast(pm10 as decimal(10,2)) as double) as pm10,
         cast(cast(no2_ppm as decimal(8,3)) as double) as no2_ppm,
         cast(cast(temperature_c as decimal(5,2)) as double) as temperature_c,
         cast(cast(humidity as decimal(5,2)) as double) as humidity,
         cast(cast(wind_speed as decimal(5,2)) as double) as wind_speed,
         cast(cast(data_quality_score as decimal(3,2)) as double) as data_quality_score, 'Normal' as status
       from readings"""
)
def conform_readings(t):
    older_layout = t.readings.withColumnsRenamed(
        {"record_id": "reading_id", "ts": "timestamp", "humidity": "humidity_percent", "wind_speed": "wind_speed_ms"}
    )
    measures = ["pm25", "co2_ppm", "pm10", "no2_ppm", "temperature_c", "humidity", "wind_speed", "data_quality_score"]
    return quality.conform_readings(older_layout).selectExpr(
        "record_id", "station_id", "ts", *[f"cast({c} as double) as {c}" for c in measures], "status"
    )


DRIFTED = """drifted as (select record_id, station_id, ts, pm25 - 5 as pm25, co2_ppm, pm10 - 5 as pm10, no2_ppm, o3_ppm,
         humidity + 35 as humidity, wind_speed - 1 as wind_speed, wind_direction + 5 as wind_direction,
         atmospheric_pressure, data_quality_score from readings),
       checked as (select record_id, concat_ws(',',
         case when co2_ppm < 0 then 'co2_ppm_range' end, case when pm25 < 0 then 'pm25_range' end,
         case when pm10 < 0 then 'pm10_range' end, case when no2_ppm < 0 then 'no2_ppm_range' end,
         case when o3_ppm < 0 then 'o3_ppm_range' end,
         case when humidity < 0 or humidity > 100 then 'humidity_range' end,
         case when wind_speed < 0 then 'wind_speed_range' end,
         case when wind_direction < 0 or wind_direction > 360 then 'wind_direction_range' end) as violations
         from drifted)"""


def drifted(t: TestTables) -> DataFrame:
    """Readings of sensors whose calibration has drifted, so that some leave their ranges."""
    shifts = {"pm25": -5, "pm10": -5, "humidity": 35, "wind_speed": -1, "wind_direction": 5}
    return t.readings.withColumns({c: F.expr(f"{c} + ({by})") for c, by in shifts.items()})


@query(f", {DRIFTED} select record_id, violations from checked where violations <> ''")
def validate_readings(t):
    rejected = quality.quarantine_rows(quality.validate_readings(drifted(t)))
    return rejected.select("record_id", F.array_join("violations", ",").alias("violations"))


@query(f", {DRIFTED} select record_id from checked where violations = ''")
def valid_readings(t):
    return quality.good_rows(quality.validate_readings(drifted(t))).select("record_id")


@query(
    """select record_id, station_id from readings
       where station_id not in (select station_id from stations where is_active)""",
    "readings stations",
)
def orphan_rows(t):
    in_use = filters.active_stations(t.stations)
    return quality.orphan_rows(t.readings.select("record_id", "station_id"), in_use, "station_id").select(
        "record_id", "station_id"
    )


@query(
    """select city_zone, latitude, longitude, count(*) as rows from stations
       where latitude is not null and longitude is not null group by 1, 2, 3 having count(*) > 1""",
    "stations",
)
def duplicate_keys(t):
    return quality.duplicate_keys(t.stations, ["city_zone", "latitude", "longitude"])


@query(
    """, counted as (
         select 'severity' as "column", severity as value, count(*) as rows from alerts group by 2
         union all select 'status', status, count(*) from sensors group by 2
         union all select 'aqi_pred', aqi_pred, count(*) from predictions group by 2
         union all select 'sensor_type', sensor_type, count(*) from readings group by 2)
       select "column", value, list_position(
           case "column" when 'severity' then ['Low','Moderate','High','Critical']
             when 'status' then ['Active','Inactive','Maintenance','Offline']
             when 'aqi_pred' then ['Good','Moderate','Unhealthy','Hazardous']
             else ['click','purchase','view'] end, value)::bigint as rank, rank is not null as is_declared, rows
       from counted""",
    "alerts sensors predictions readings",
)
def enum_check(t):
    return (
        quality.enum_check(t.alerts, "severity", SEVERITIES)
        .unionByName(quality.enum_check(t.sensors, "status", SENSOR_STATUSES))
        .unionByName(quality.enum_check(t.predictions, "aqi_pred", AQI_LABELS))
        .unionByName(quality.enum_check(t.readings, "sensor_type", ["click", "purchase", "view"]))
    )


# --- derived columns --------------------------------------------------------------------------


@query("select record_id, pm25, aqi_bucket from labelled", "labelled")
def aqi_bucket(t):
    return derive.with_aqi_bucket(t.readings).select("record_id", "pm25", "aqi_bucket")


@query(
    """select record_id,
         case when pm25 > 100 or co2_ppm > 850 then 'Critical' when pm25 > 55 or co2_ppm > 700 then 'Alert'
              when pm25 > 35 or co2_ppm > 600 then 'Warning' else 'Normal' end as status_4,
         case when pm25 > 100 or co2_ppm > 800 then 'Alert' when pm25 > 55 or co2_ppm > 600 then 'Warning'
              else 'Normal' end as status_3
       from readings"""
)
def reading_status(t):
    both = derive.with_reading_status(t.readings, ladders.STATUS_4, "status_4")
    return derive.with_reading_status(both, ladders.STATUS_3, "status_3").select("record_id", "status_4", "status_3")


@query(
    """select record_id, round(pm10 / (pm25 + cast(0.001 as double)), 6) as pm_ratio,
         round(temperature_c * humidity, 6) as temp_humidity,
         round(pm25 + no2_ppm*100 + o3_ppm*100, 6) as pollution_index
       from readings"""
)
def derived_features(t):
    columns = ["pm_ratio", "temp_humidity", "pollution_index"]
    return rounded(derive.with_derived_features(t.readings).select("record_id", *columns), *columns)


@query(
    """, m as (select median(pm10) as pm10, median(temperature_c) as temperature_c from w)
       select record_id, round(coalesce(w.pm10, m.pm10), 6) as pm10,
         round(coalesce(w.temperature_c, m.temperature_c), 6) as temperature_c
       from w cross join m""",
    "w",
)
def impute_median_query(t):
    columns = ["pm10", "temperature_c"]
    return rounded(impute_median(gated_week(t).select("record_id", *columns), columns), *columns)


KPI_SQL = f"""select round(avg(pm25), 6) as avg_pm25, round(avg(co2_ppm), 6) as avg_co2, max(pm25) as max_pm25,
         count(*) as total_records,
         (select count(*) from (select * from alerts order by created_at desc, alert_id desc limit 200)
          where status = 'Open') as active_alerts
       from readings where {SINCE_WEEK}"""


def loaded_kpis(t: TestTables) -> DataFrame:
    """Key figures of the last week and of the newest 200 alerts."""
    newest = joins.newest_alerts(t.alerts, 200)
    return aggregates.kpi_summary(week(t), newest)


@query(
    f""", k as ({KPI_SQL})
       select case when avg_pm25 > 35 then 'red' when avg_pm25 > 12 then 'yellow' else 'green' end as avg_pm25_band,
         case when avg_co2 > 600 then 'red' when avg_co2 > 500 then 'yellow' else 'green' end as avg_co2_band,
         case when max_pm25 > 100 then 'red' when max_pm25 > 55 then 'yellow' else 'green' end as max_pm25_band,
         case when active_alerts > 10 then 'red' when active_alerts > 0 then 'yellow' else 'green' end as active_alerts_band
       from k""",
    "readings alerts",
)
def kpi_bands(t):
    return aggregates.kpi_bands(loaded_kpis(t))


@query(
    """select metric_id, case metric_name when 'avg_pm25' then 'Avg Pm25' when 'max_pm25' then 'Max Pm25'
           else 'Reading Count' end as title,
         cast(cast(round(cast(metric_value as decimal(20,6)), 2) as decimal(20,2)) as varchar) || ' ' || metric_unit as value_text,
         strftime(recorded_at, '%Y-%m-%d %H:%M:%S') as time_text
       from system_metrics""",
    "system_metrics",
)
def metric_display(t):
    return derive.metric_display(t.system_metrics)


@query("select created_at, alert_type, severity, message, status from alerts", "alerts")
def select_available(t):
    # The zone is only there after a join, and is left out here.
    return derive.select_available(
        t.alerts, ["created_at", "city_zone", "alert_type", "severity", "message", "status"]
    )


# --- filters ----------------------------------------------------------------------------------


@query(f"select record_id, ts, pm25 from readings where {SINCE_WEEK}")
def recent_readings(t):
    return filters.recent(t.readings, WEEK).select("record_id", "ts", "pm25")


@query(
    """select record_id, data_quality_score > cast(0.8 as double) and aqi_bucket is not null as trains from labelled
       where data_quality_score > cast(0.7 as double) and pm25 is not null and co2_ppm is not null""",
    "labelled",
)
def quality_gate(t):
    labelled = derive.with_aqi_bucket(t.readings)
    trains = filters.training_gate(labelled).select("record_id", F.lit(True).alias("trains"))
    return (
        filters.quality_gate(labelled).select("record_id").join(trains, "record_id", "left")
        .withColumn("trains", F.coalesce("trains", F.lit(False)))
    )


@query("select station_id, city_zone from stations where is_active", "stations")
def active_stations(t):
    return filters.active_stations(t.stations).select("station_id", "city_zone")


@query("select alert_id, severity from alerts where status = 'Open'", "alerts")
def open_alerts(t):
    return filters.open_alerts(t.alerts).select("alert_id", "severity")


@query(
    f""", day as (select * from readings where ts >= (select max(ts) from readings) - interval '1' hour)
       select record_id, 'week' as span from w where (select count(*) from w) >= 20
       union all select record_id, 'hour' from day where (select count(*) from day) >= 20""",
    "w",
)
def min_rows_guard(t):
    enough = filters.min_rows_guard(gated_week(t).select("record_id"), 20)
    few = filters.min_rows_guard(filters.recent(t.readings, 60).select("record_id"), 20)
    return enough.withColumn("span", F.lit("week")).unionByName(few.withColumn("span", F.lit("hour")))


# --- joins ------------------------------------------------------------------------------------


@query(
    f"""select a.record_id, a.station_id, a.ts, a.pm25, a.co2_ppm, a.temperature_c, a.humidity, a.wind_speed,
         s.city_zone, s.latitude, s.longitude, p.aqi_pred
       from (select * from readings where {SINCE_WEEK} order by ts desc, record_id desc limit 1000) a
       join (select * from stations where is_active) s on a.station_id = s.station_id
       left join predictions p on a.record_id = p.record_id""",
    "readings stations predictions",
)
def dashboard_readings(t):
    return joins.dashboard_readings(
        filters.recent(t.readings, WEEK), filters.active_stations(t.stations), t.predictions, 1000
    )


@query(
    f"""select a.record_id, a.station_id, a.ts, a.pm25, a.co2_ppm, a.sensor_type, s.city_zone, s.latitude, s.longitude,
         p.aqi_pred, p.proba_good, p.proba_moderate, p.proba_unhealthy, p.proba_hazardous, p.confidence_score,
         p.model_version
       from readings a join (select * from stations where is_active) s on a.station_id = s.station_id
       left join predictions p on a.record_id = p.record_id
       where {SINCE_WEEK} order by a.ts desc, a.record_id desc limit 1000""",
    "readings stations predictions",
)
def dashboard_readings_full(t):
    columns = ["record_id", "station_id", "ts", "pm25", "co2_ppm", "sensor_type"]
    full = joins.dashboard_readings_full(
        filters.recent(t.readings, WEEK).select(*columns), filters.active_stations(t.stations), t.predictions, 1000
    )
    return full.select(*columns, "city_zone", "latitude", "longitude", *joins.PREDICTION_COLUMNS)


@query(
    """select alert_id, record_id, a.station_id, alert_type, severity, status, message, round(anomaly_score, 6) as anomaly_score,
         created_at, city_zone, latitude, longitude
       from alerts a join (select * from stations where is_active) s on a.station_id = s.station_id
       order by created_at desc, alert_id desc limit 200""",
    "alerts stations",
)
def alerts_with_station(t):
    joined = joins.alerts_with_station(t.alerts, filters.active_stations(t.stations))
    return rounded(joined.drop("detection_method"), "anomaly_score")


@query(
    """select s.station_id, n.sensor_id, n.sensor_type from stations s join sensors n on s.station_id = n.station_id
       where s.is_active and n.status = 'Active'""",
    "stations sensors",
)
def active_sensors(t):
    return joins.active_sensors(t.stations, t.sensors)


LINEAGE_SQL = """select r.record_id, s.station_name, s.city_zone, n.sensor_type, r.pm25, r.ts, p.aqi_pred, a.alert_type, a.severity
       from readings r join stations s on r.station_id = s.station_id join sensors n on r.sensor_id = n.sensor_id
       left join predictions p on r.record_id = p.record_id left join alerts a on r.record_id = a.record_id"""


@query(LINEAGE_SQL, "readings stations sensors predictions alerts")
def reading_lineage(t):
    return joins.reading_lineage(t.readings, t.stations, t.sensors, t.predictions, t.alerts)


@query(LINEAGE_SQL, "readings stations sensors predictions alerts")
def stored_reading_lineage(t):
    """The same from the stored tables, over all times, written side by side in buckets."""
    store = store_of(t)
    newest = store.latest()
    write_history(store, newest - dt.timedelta(days=3650), newest + dt.timedelta(seconds=1), version=1, buckets=8)
    return history_lineage(store)


# --- aggregations -----------------------------------------------------------------------------


@query(KPI_SQL, "readings alerts")
def kpi_summary(t):
    return rounded(loaded_kpis(t), "avg_pm25", "avg_co2")


@query(
    """select (select pm25 from readings where pm25 is not null order by ts desc, record_id desc limit 1) as latest_pm25,
         (select round(avg(temperature_c), 6) from readings) as avg_temperature,
         (select count(*) from stations where is_active) as active_stations,
         (select count(*) from alerts where status = 'Open') as open_alerts""",
    "readings stations alerts",
)
def kpi_overview(t):
    return rounded(aggregates.kpi_overview(t.readings, t.stations, t.alerts), "avg_temperature")


@query(
    """select s.severity, count(a.alert_id) as open_alerts
       from (values ('Low'), ('Moderate'), ('High'), ('Critical')) s(severity)
       left join (select * from alerts where status = 'Open') a on a.severity = s.severity group by 1""",
    "alerts",
)
def severity_counts(t):
    return aggregates.severity_counts(t.alerts)


@query(
    """select count(*) as predictions from predictions
       where predicted_at >= (select max(predicted_at) from predictions) - interval '1' day""",
    "predictions",
)
def recent_prediction_count(t):
    return aggregates.recent_prediction_count(t.predictions, minutes=24 * 60)


ZSUM = """z as (select w.*,
         abs((pm25 - (select avg(pm25) from w)) / ((select stddev_samp(pm25) from w) + cast(1e-6 as double)))
         + abs((co2_ppm - (select avg(co2_ppm) from w)) / ((select stddev_samp(co2_ppm) from w) + cast(1e-6 as double)))
           as anomaly_score from w)"""


@query(
    f""", {ZSUM}, f as (select avg(pm25) as a, cast(count(*) filter (anomaly_score > 5) as double) as b,
         avg(cast(case when pm10 <= 12 then 'Good' when pm10 <= 35 then 'Moderate' when pm10 <= 55 then 'Unhealthy'
             when pm10 is not null then 'Hazardous' else '' end = aqi_bucket as double)) as c from z)
       select 'avg_pm25_batch' as metric_name, round(a, 6) as metric_value, 'µg/m³' as metric_unit from f
       union all select 'anomaly_count', b, 'count' from f
       union all select 'stream_model_accuracy', round(c, 6), 'score' from f""",
    "w",
)
def batch_metrics(t):
    # The class that PM10 would suggest stands in for a prediction.
    batch = outliers.zsum_outliers(gated_week(t)).withColumn("aqi_pred", F.expr(ladders.aqi_bucket("pm10")))
    return rounded(aggregates.batch_metrics(batch), "metric_value")


@query(
    """, log as (select s.city_zone as run_id, cast(date_diff('day', date '2024-01-01', cast(r.ts as date)) as bigint) as cycle,
           count(*) filter (r.pm25 > 100) as outliers, count(r.pm25) as predictions, cast(count(*) as double)/10 as seconds
         from readings r join stations s on r.station_id = s.station_id group by 1, 2),
       totals as (select *, count(*) over o as n, avg(outliers) over o as ao, avg(predictions) over o as ap from log
         window o as (partition by run_id order by cycle rows unbounded preceding))
       select run_id, cycle, metric_name, round(metric_value, 6) as metric_value, metric_unit from (
         select run_id, cycle, 'outliers_detected' as metric_name, cast(outliers as double) as metric_value, 'count' as metric_unit from totals
         union all select run_id, cycle, 'predictions_generated', cast(predictions as double), 'count' from totals
         union all select run_id, cycle, 'monitoring_cycle_time', seconds, 'seconds' from totals
         union all select run_id, cycle, 'total_cycles', cast(n as double), 'count' from totals
         union all select run_id, cycle, 'avg_outliers_per_cycle', ao, 'count' from totals
         union all select run_id, cycle, 'avg_predictions_per_cycle', ap, 'count' from totals)""",
    "readings stations",
)
def cycle_metrics(t):
    """A log with one monitor run per zone and one cycle per day."""
    log = (
        t.readings.join(t.stations.select("station_id", "city_zone"), "station_id")
        .selectExpr("city_zone as run_id", "cast(datediff(to_date(ts), date'2024-01-01') as bigint) as cycle", "pm25")
        .groupBy("run_id", "cycle")
        .agg(
            F.expr("count_if(pm25 > 100) as outliers"),
            F.expr("count(pm25) as predictions"),
            F.expr("cast(count(*) as double) / 10 as seconds"),
        )
    )
    return rounded(aggregates.cycle_metrics(log), "metric_value")


@query(
    """select s.station_id, s.station_name, s.city_zone, coalesce(n.c, 0) as sensor_count, r.last_reading,
         round(r.a, 6) as avg_pm25, coalesce(r.c, 0) as reading_count
       from stations s left join (select station_id, count(*) as c from sensors group by 1) n on n.station_id = s.station_id
       left join (select station_id, max(ts) as last_reading, avg(pm25) as a, count(*) as c from readings group by 1) r
         on r.station_id = s.station_id""",
    "stations sensors readings",
)
def station_statistics(t):
    return rounded(aggregates.station_statistics(t.stations, t.sensors, t.readings), "avg_pm25")


@query(
    """select sensor_id, round(avg(data_quality_score), 6) as avg_quality, count(*) as readings from readings
       where sensor_id is not null group by 1 having avg(data_quality_score) < cast(0.7 as double)"""
)
def sensors_needing_attention(t):
    return rounded(aggregates.sensors_needing_attention(t.readings), "avg_quality")


# --- latest rows and series -------------------------------------------------------------------


@query(
    """select * from (
         select r.station_id, r.record_id, r.ts, r.pm25, s.city_zone, s.latitude, s.longitude
         from readings r join stations s on r.station_id = s.station_id
         qualify row_number() over (partition by r.station_id order by r.ts desc, r.record_id desc) = 1)
       where latitude is not null and longitude is not null""",
    "readings stations",
)
def latest_per_station(t):
    return series.latest_per_station(t.readings.select("station_id", "record_id", "ts", "pm25"), t.stations)


@query(
    """select metric_id, metric_name, round(metric_value, 6) as metric_value, metric_unit, recorded_at
       from system_metrics order by recorded_at desc, metric_id desc limit 20""",
    "system_metrics",
)
def recent_metrics(t):
    return rounded(series.recent_metrics(t.system_metrics, 20), "metric_value")


@query(
    """, newest as (select * from system_metrics order by recorded_at desc, metric_id desc limit 40),
       chosen as (select metric_name, count(*) as n from newest group by 1
                  order by max(recorded_at) desc, max(metric_id) desc limit 2)
       select metric_id, metric_name, round(metric_value, 6) as metric_value, metric_unit, recorded_at from newest
       where metric_name in (select metric_name from chosen where n > 1)""",
    "system_metrics",
)
def metric_series(t):
    columns = ["metric_id", "metric_name", "metric_value", "metric_unit", "recorded_at"]
    return rounded(series.metric_series(t.system_metrics, 40, 2).select(*columns), "metric_value")


@query(
    """select metric_id, metric_name, round(metric_value, 6) as metric_value, recorded_at from system_metrics
       where metric_name in ('avg_pm25', 'reading_count')""",
    "system_metrics",
)
def named_metric_series(t):
    rows = series.named_metric_series(t.system_metrics, ["avg_pm25", "reading_count"])
    return rounded(rows.drop("metric_unit"), "metric_value")


@query(
    """select s.city_zone, r.ts, r.pm25, r.record_id from readings r join stations s on r.station_id = s.station_id""",
    "readings stations",
)
def zone_series(t):
    return series.zone_series(t.readings.join(t.stations, "station_id"))


# --- outliers and alerts ----------------------------------------------------------------------

_z = " or ".join(
    f"abs((coalesce({c}, m_{c}) - avg(coalesce({c}, m_{c})) over ()) / nullif(stddev_samp(coalesce({c}, m_{c})) over (), 0)) > 3"
    for c in MONITOR_FEATURES
)
FLAGGED = f"""flagged as (select *, coalesce({_z}, false) as is_statistical_outlier from w cross join
       (select {", ".join(f"median({c}) as m_{c}" for c in MONITOR_FEATURES)} from w) m)"""


@query(f", {FLAGGED} select record_id, is_statistical_outlier from flagged", "w")
def zscore_outliers(t):
    return outliers.zscore_outliers(gated_week(t)).select("record_id", "is_statistical_outlier")


@query(f", {ZSUM} select record_id, round(anomaly_score, 6) as anomaly_score, anomaly_score > 5 as is_anomaly from z", "w")
def zsum_outliers(t):
    flagged = outliers.zsum_outliers(gated_week(t))
    return rounded(flagged.select("record_id", "anomaly_score", "is_anomaly"), "anomaly_score")


@query()
def isolation_forest_fit(t):
    return forest.fit_isolation_forest(
        gated_week(t), MONITOR_FEATURES, trees=200, max_samples=1000
    )


@query("select cast(t as int) as tree_id, true as is_binary, true as is_whole from range(200) r(t)")
def isolation_forest_shape(t):
    """Every tree has one more leaf than splits, and its nodes are numbered without gaps."""
    nodes = forest.fit_isolation_forest(gated_week(t), MONITOR_FEATURES, trees=200, max_samples=1000)
    counted = nodes.groupBy("tree_id").agg(
        F.expr("count_if(feature < 0)").alias("leaves"), F.count("*").alias("nodes"), F.max("node_id").alias("last")
    )
    return counted.select(
        "tree_id", (F.col("nodes") == 2 * F.col("leaves") - 1).alias("is_binary"),
        (F.col("last") == F.col("nodes") - 1).alias("is_whole"),
    )


@query()
def isolation_forest_score(t):
    window = gated_week(t).select("record_id", "station_id", *FOREST_FEATURES)
    nodes = forest.fit_isolation_forest(window, FOREST_FEATURES)
    flagged = forest.isolation_outliers(window, nodes, FOREST_FEATURES)
    return flagged.select("record_id", "station_id", "isolation_score", "is_isolation_outlier")


# A forest by rule: complete trees of seven splits, with thresholds near the features' means, and its nodes for the SQL.
GIVEN_SPREAD = {"co2_ppm": (500.0, 100.0), "pm25": (60.0, 25.0), "pm10": (70.0, 30.0), "temperature_c": (20.0, 8.0),
                "humidity": (50.0, 15.0)}
GIVEN_TREES, GIVEN_SPLITS, GIVEN_SAMPLE = 4, 7, 256


def _given_node(tree: int, node: int) -> tuple:
    if node >= GIVEN_SPLITS:
        return tree, node, -1, 0.0, -1, -1, 2.0 + (3 * node + tree) % 8 / 2, GIVEN_SAMPLE
    feature = (tree + node) % len(FOREST_FEATURES)
    mean, spread = GIVEN_SPREAD[FOREST_FEATURES[feature]]
    return tree, node, feature, mean + spread * ((3 * node + 5 * tree) % 7 - 3) / 4, 2 * node + 1, 2 * node + 2, 0.0, GIVEN_SAMPLE


GIVEN_FOREST = [_given_node(tree, node) for tree in range(GIVEN_TREES) for node in range(2 * GIVEN_SPLITS + 1)]
_NODE_VALUES = ", ".join(
    f"({tree}, {node}, {feature}, {threshold!r}::double, {left}, {right}, {path!r}::double)"
    for tree, node, feature, threshold, left, right, path, _ in GIVEN_FOREST
)
_FOREST_VALUES = ", ".join(f"coalesce({c}, (select median({c}) from w))" for c in FOREST_FEATURES)


@query(
    f""", nodes(tree, node, feature, threshold, lft, rgt, path) as (values {_NODE_VALUES}),
       x as (select record_id, [{_FOREST_VALUES}] as v from w),
       walk as (select record_id, v, tree, path, case when v[feature + 1] <= threshold then lft else rgt end as next
           from x, nodes where node = 0),
       second as (select record_id, v, walk.tree, nodes.path, case when v[feature + 1] <= threshold then lft else rgt end as next
           from walk join nodes on nodes.tree = walk.tree and nodes.node = walk.next),
       third as (select record_id, v, second.tree, nodes.path, case when v[feature + 1] <= threshold then lft else rgt end as next
           from second join nodes on nodes.tree = second.tree and nodes.node = second.next),
       scores as (select record_id, pow(2, -avg(nodes.path) / (2 * (ln({GIVEN_SAMPLE - 1}) + 0.5772156649015329)
             - 2 * {GIVEN_SAMPLE - 1}::double / {GIVEN_SAMPLE})) as score
           from third join nodes on nodes.tree = third.tree and nodes.node = third.next group by record_id)
       select record_id, round(score, 6) as isolation_score,
         score > (select quantile_cont(score, 0.95) from scores) as is_isolation_outlier from scores""",
    "w",
)
def isolation_score_by_nodes(t):
    """Scores and flags by a given forest: every walk down its trees, step by step."""
    window = gated_week(t).select("record_id", *FOREST_FEATURES)
    nodes = t.spark.createDataFrame(GIVEN_FOREST, forest.NODES)
    flagged = forest.isolation_outliers(window, nodes, FOREST_FEATURES)
    return rounded(flagged.select("record_id", "isolation_score", "is_isolation_outlier"), "isolation_score")


@query()
def stream_forest_outliers(t):
    """Two one-feature forests, and the rows above the 98th percentile of their mean score."""
    batch = gated_week(t).select("record_id", "pm25", "co2_ppm")
    scored = forest.stream_forest_scores(
        batch, forest.fit_isolation_forest(batch, ["pm25"]), forest.fit_isolation_forest(batch, ["co2_ppm"])
    )
    return outliers.percentile_outliers(materialized(scored, "scores"))


@query(
    """select record_id, pm25, pm25 > (select quantile_cont(pm25, 0.98) from w) as is_anomaly from w""", "w"
)
def percentile_outliers(t):
    return outliers.percentile_outliers(gated_week(t).select("record_id", "pm25"), "pm25")


ANOMALY_TEXT = """'PM2.5=' || cast(round(cast(cast(pm25 as varchar) as decimal(38,18)),1) as varchar) || '{unit}, CO2='
         || cast(round(cast(cast(co2_ppm as varchar) as decimal(38,18)),0) as varchar) || 'ppm'"""


@query(
    f""", two as (select *, pm10 > 100 or humidity > 68 as st, co2_ppm > 850 or pm25 > 120 as fo from w)
       select record_id, station_id, 'Anomaly' as alert_type,
         case when pm25 > 150 or co2_ppm > 1000 then 'Critical' when pm25 > 100 or co2_ppm > 800 then 'High'
              when pm25 > 55 or co2_ppm > 600 then 'Moderate' else 'Low' end as severity,
         'Anomaly detected at station ' || cast(station_id as varchar) || ': '
           || {ANOMALY_TEXT.format(unit="μg/m³")} || ', Temp='
           || coalesce(cast(round(cast(cast(temperature_c as varchar) as decimal(38,18)),1) as varchar), 'nan') || '°C' as message,
         round(cast(least(1.0, case when fo then 0.8 else 0.6 end + case when st then 0.2 else 0 end) as double), 3) as anomaly_score,
         concat_ws('|', case when st then 'Statistical' end, case when fo then 'IsolationForest' end) as detection_method,
         ts as created_at
       from (select * exclude (st, fo), coalesce(st, false) as st, coalesce(fo, false) as fo from two) where st or fo""",
    "w",
)
def anomaly_alerts(t):
    """The alert rule on two given flags, here simple limits in place of the detectors."""
    flags = {
        "is_statistical_outlier": "coalesce(pm10 > 100 or humidity > 68, false)",
        "is_isolation_outlier": "coalesce(co2_ppm > 850 or pm25 > 120, false)",
    }
    flagged = gated_week(t).withColumns({name: F.expr(rule) for name, rule in flags.items()})
    return alerts.anomaly_alerts(flagged)


@query(
    f"""select record_id, station_id, 'Anomaly' as alert_type,
         case when pm25 > 100 or co2_ppm > 800 then 'Critical' else 'High' end as severity,
         'Anomaly detected: ' || {ANOMALY_TEXT.format(unit="")} as message, cast(0.8 as double) as anomaly_score,
         'IsolationForest' as detection_method, ts as created_at
       from w where pm25 > 90 or humidity > 68""",
    "w",
)
def anomaly_alerts_simple(t):
    flagged = gated_week(t).withColumn("is_outlier", F.expr("pm25 > 90 or humidity > 68"))
    return alerts.anomaly_alerts_simple(flagged)


@query(
    f""", {ZSUM}
       select record_id, station_id, 'Outlier Detected' as alert_type,
         case when anomaly_score > 5 then 'High' else 'Moderate' end as severity,
         'Anomaly: PM2.5=' || cast(round(cast(cast(pm25 as varchar) as decimal(38,18)),1) as varchar) || ', CO₂='
           || cast(round(cast(cast(co2_ppm as varchar) as decimal(38,18)),0) as varchar) || ' ppm' as message,
         round(anomaly_score, 6) as anomaly_score, 'BatchOutlier' as detection_method, ts as created_at
       from z where anomaly_score > cast(2.5 as double)""",
    "w",
)
def batch_outlier_alerts(t):
    # A lower limit than the default, so that both severities occur.
    flagged = outliers.zsum_outliers(gated_week(t), limit=2.5)
    return rounded(alerts.batch_outlier_alerts(flagged), "anomaly_score")


@query(
    """select record_id, station_id, alert_type, severity, message, round(anomaly_score, 6) as anomaly_score,
         detection_method, created_at from threshold""",
    "threshold",
)
def threshold_alerts(t):
    return rounded(alerts.threshold_alerts(t.readings), "anomaly_score")


@query(
    """select record_id, station_id, 'PM2.5 High' as alert_type,
         case when pm25 > 100 then 'Critical' when pm25 > 75 then 'High' else 'Moderate' end as severity, 'Open' as status,
         'PM2.5 level ' || cast(round(cast(cast(pm25 as varchar) as decimal(38,18)),1) as varchar) || ' μg/m³ exceeds safe threshold' as message,
         ts as created_at
       from readings where pm25 > 50"""
)
def pm25_high_alerts(t):
    return alerts.pm25_high_alerts(t.readings)


# --- model ------------------------------------------------------------------------------------


def training_rows(t: TestTables) -> DataFrame:
    return filters.training_gate(derive.with_aqi_bucket(t.readings))


@query()
def train_aqi_model(t):
    """Accuracy of a full training run on the rows it was trained on."""
    training = training_rows(t)
    scored = model.score_aqi(training, model.train_aqi_model(training, TRAINING_FEATURES), keep=("aqi_bucket",))
    return aggregates.model_accuracy(scored, "aqi_pred", "aqi_bucket")


@query(
    f"""select 1::bigint as version, count(case when not held then 1 end) as train_rows, count(case when held then 1 end) as held_out_rows,
         'taken' as action, 1::bigint as chosen
       from (select substr(md5(cast(record_id as varchar)), 1, 1) in ('0', '1', '2') as held from labelled
             where {SINCE_WEEK} and data_quality_score > cast(0.8 as double) and pm25 is not null
               and co2_ppm is not null and aqi_bucket is not null)""",
    "readings labelled",
)
def full_model_registry(t):
    """The entry of a training run on the last week of stored readings: rows trained on and held out."""
    store = Store(t.spark, scratch_path(t.spark, "training"))
    write_partitioned(t.readings, store.path("readings"))
    train_full_model(t.spark, store, version=1, minutes=WEEK)
    return store.model_registry().select("version", "train_rows", "held_out_rows", "action", "chosen")


@query()
def update_aqi_model(t):
    """Model state after two incremental steps."""
    training = training_rows(t)
    return model.update_aqi_model(training, STREAM_FEATURES, model.update_aqi_model(training, STREAM_FEATURES))


@query()
def score_aqi(t):
    window = gated_week(t)
    return model.score_aqi(window, model.train_aqi_model(training_rows(t))).drop("ts")


_STATE_VALUES = {c: f"coalesce({c}, (select median({c}) from train))" for c in STREAM_FEATURES}


@query(
    """, train as (select * from labelled where data_quality_score > cast(0.8 as double) and pm25 is not null
         and co2_ppm is not null and aqi_bucket is not null)
    """ + " union all ".join(
        f"select '{c}' as feature, 2.0::double * count(*) as n, round(avg({x}), 6) as mean, round(2 * var_pop({x}) * count(*), 3) as m2"
        " from train" for c, x in _STATE_VALUES.items()
    ),
    "labelled",
)
def model_state_moments(t):
    """Count, mean and squared deviations that the model state has after two steps on the same rows."""
    training = training_rows(t)
    state = model.update_aqi_model(training, STREAM_FEATURES, model.update_aqi_model(training, STREAM_FEATURES))
    return state.where(F.col("feature").isin(STREAM_FEATURES)).select(
        "feature", "n", F.round("mean", 6).alias("mean"), F.round("m2", 3).alias("m2")
    )


# A model state by rule, with mean and deviation near those of the features, and its weights for the SQL.
GIVEN_MOMENTS = {"pm25": (60.0, 25.0), "co2_ppm": (500.0, 100.0), "temperature_c": (20.0, 8.0), "humidity": (50.0, 15.0),
                 "wind_speed": (3.0, 2.0), model.BIAS: (0.0, 0.0)}
GIVEN_STATE = [
    (name, 4.0, mean, 4.0 * spread * spread, *[((i + 1) * (k + 2) % 7 - 3) / 4 for k in range(len(AQI_LABELS))])
    for i, (name, (mean, spread)) in enumerate(GIVEN_MOMENTS.items())
]
_WEIGHTS = ", ".join(
    f"('{name}', {mean}::double, {m2}::double / {n}::double, {k}, {weight}::double)"
    for name, n, mean, m2, *weights in GIVEN_STATE for k, weight in enumerate(weights)
)
_GIVEN_VALUES = " union all ".join(
    f"select record_id, '{c}' as feature, coalesce({c}, (select median({c}) from w)) as x from w" for c in STREAM_FEATURES
)
_GIVEN_LABELS = " ".join(f"when {k} then '{name}'" for k, name in enumerate(AQI_LABELS))


@query(
    f""", weights(feature, mean, variance, k, weight) as (values {_WEIGHTS}),
       x as ({_GIVEN_VALUES}),
       logits as (select record_id, k, sum((x - mean) / sqrt(variance) * weight)
           + (select weight from weights b where b.feature = '{model.BIAS}' and b.k = weights.k) as logit
         from x join weights using (feature) group by record_id, k),
       chances as (select record_id, k, 1 / (1 + exp(-greatest(-30, least(30, logit)))) as c from logits),
       p as (select record_id, k, c / sum(c) over (partition by record_id) as p from chances)
       select record_id, case arg_min(k, (-p, k)) {_GIVEN_LABELS} end as aqi_pred, round(max(p), 6) as confidence_score,
         {", ".join(f"round(max(case when k = {k} then p end), 6) as {name}" for k, name in enumerate(model.PROBABILITIES))}
       from p group by record_id""",
    "w",
)
def score_aqi_by_state(t):
    """Label, probabilities and confidence by a given model state: plain arithmetic over its weights."""
    state = t.spark.createDataFrame(GIVEN_STATE, model.STATE)
    scored = model.score_aqi(gated_week(t), state)
    return rounded(scored.select("record_id", "aqi_pred", "confidence_score", *model.PROBABILITIES), "confidence_score", *model.PROBABILITIES)


@query("select record_id, true as sums_to_one, true as is_likeliest from w", "w")
def score_aqi_consistent(t):
    """Probabilities of every scored reading add up to one, and the label has the largest of them."""
    state = model.update_aqi_model(training_rows(t), STREAM_FEATURES)
    chances = [f"proba_{name.lower()}" for name in AQI_LABELS]
    of_label = F.expr("case aqi_pred " + " ".join(f"when '{n}' then proba_{n.lower()}" for n in AQI_LABELS) + " end")
    return model.score_aqi(gated_week(t), state).select(
        "record_id", (F.abs(F.expr(" + ".join(chances)) - 1) < 1e-9).alias("sums_to_one"),
        ((of_label == F.greatest(*chances)) & (F.col("confidence_score") == of_label)).alias("is_likeliest"),
    )


@query(
    """select record_id, station_id, 'Good' as aqi_pred, cast(0.25 as double) as proba_good,
         cast(0.25 as double) as proba_moderate, cast(0.25 as double) as proba_unhealthy,
         cast(0.25 as double) as proba_hazardous, cast(0.25 as double) as confidence_score from w""",
    "w",
)
def score_aqi_untrained(t):
    """Without a model every class is as likely."""
    return model.score_aqi(gated_week(t), None).drop("ts", "predicted_at", "model_version")


@query(
    """select round(avg(cast(coalesce(case when pm10 <= 12 then 'Good' when pm10 <= 35 then 'Moderate'
           when pm10 <= 55 then 'Unhealthy' when pm10 is not null then 'Hazardous' end, 'Good') = aqi_bucket as double)), 6) as accuracy
       from labelled where aqi_bucket is not null""",
    "labelled",
)
def model_accuracy(t):
    # The class that PM10 would suggest stands in for a prediction.
    guess = f"coalesce({ladders.aqi_bucket('pm10')}, 'Good')"
    labelled = derive.with_aqi_bucket(t.readings).withColumn("aqi_pred", F.expr(guess))
    return rounded(aggregates.model_accuracy(labelled, "aqi_pred", "aqi_bucket"), "accuracy")


# --- streaming and monitoring -----------------------------------------------------------------


#: A stream takes all files that have landed since it last ran as one micro-batch.
ALL_FILES = 1_000_000


def in_four_batches(t: TestTables, run: Callable[[DataFrame], StreamingQuery]) -> None:
    """Land the events of all times a quarter at a time, and ``run`` the stream of their readings after each.

    A quarter lands as a file for each core, so that no task reads or writes a whole micro-batch.
    """
    landing = scratch_path(t.spark, "landing")
    for part in range(4):
        landed = t.events.where(f"event_id % 4 = {part}").repartition(t.spark.sparkContext.defaultParallelism)
        landed.write.mode("append").parquet(landing)
        run(readings_from_events(stream_readings(t.spark, landing, EVENTS, files_per_batch=ALL_FILES))).awaitTermination()


def ingested(t: TestTables, baseline: KeptForests | None = None) -> Store:
    """A store after four micro-batches, each with a quarter of the events of all times."""
    store = Store(t.spark, scratch_path(t.spark, "ingest"), "day")
    in_four_batches(
        t, lambda readings: run_ingest_stream(t.spark, readings, store, trigger={"availableNow": True}, baseline=baseline)
    )
    return store


SAMPLE_ROWS = 300


@query(
    f"""select record_id, ts, md5(concat_ws(':', '42', record_id, epoch_us(ts))) as place, pm25, co2_ppm
        from readings order by place limit {SAMPLE_ROWS}"""
)
def run_ingest_stream_sample(t):
    """The sample that four batches have left equals the lowest places of all readings."""
    kept = KeptForests(sample_rows=SAMPLE_ROWS, min_rows=100, refit_batches=2, trees=20, max_samples=64)
    return ingested(t, kept).sample_before("ingest", 4)


@query("select record_id, station_id, sensor_id, ts, pm25, co2_ppm, temperature_c, humidity, aqi_bucket from labelled",
       "readings labelled")
def ingest_readings(t):
    """What the stream has stored: every reading once."""
    return ingested(t).all_readings().select(
        "record_id", "station_id", "sensor_id", "ts", "pm25", "co2_ppm", "temperature_c", "humidity", "aqi_bucket"
    )


@query(f""", {DRIFTED} select record_id, concat_ws(',', nullif(violations, ''),
           case when station_id not in (select station_id from stations where is_active) then 'station_id_orphan' end) as violations
         from checked join drifted using (record_id)
         where violations <> '' or station_id not in (select station_id from stations where is_active)""",
       "readings stations")
def quarantine_readings(t):
    """What the ingest rejects of drifted readings when only stations in use are known, as it is stored."""
    store = Store(t.spark, scratch_path(t.spark, "quarantine"))
    filters.active_stations(t.stations).withColumn("status", F.lit("Active")).withColumn("batch_id", F.lit(0)).write.partitionBy(
        "batch_id"
    ).parquet(store.path("stations"))
    admit_batch(store, drifted(t), 1)
    return store.quarantine().select("record_id", "violations")


@query(
    """, z as (select *,
         abs((pm25 - avg(pm25) over b) / (stddev_samp(pm25) over b + cast(1e-6 as double)))
         + abs((co2_ppm - avg(co2_ppm) over b) / (stddev_samp(co2_ppm) over b + cast(1e-6 as double)))
           as anomaly_score from readings window b as (partition by record_id % 4))
       select record_id, station_id, alert_type, severity, message, round(anomaly_score, 6) as anomaly_score from threshold
       union all
       select record_id, station_id, 'Outlier Detected', 'High',
         'Anomaly: PM2.5=' || cast(round(cast(cast(pm25 as varchar) as decimal(38,18)),1) as varchar) || ', CO₂='
           || cast(round(cast(cast(co2_ppm as varchar) as decimal(38,18)),0) as varchar) || ' ppm', round(anomaly_score, 6)
       from z where anomaly_score > 5""",
    "threshold",
)
def run_ingest_stream_query(t):
    """Alerts of the ingest stream; the events arrive in four micro-batches, out of order."""
    store = ingested(t)
    columns = ["record_id", "station_id", "alert_type", "severity", "message", "anomaly_score"]
    return rounded(store.alerts().select(*columns), "anomaly_score")


def monitored(t: TestTables) -> Store:
    """A store after two monitoring cycles a day apart."""
    store = Store(t.spark, scratch_path(t.spark, "monitor"), "day")
    write_partitioned(t.readings, store.path("readings"))
    as_of = store.latest()
    for cycle, day in enumerate((as_of - dt.timedelta(days=1), as_of), start=1):
        report = run_cycle(t.spark, store, cycle=cycle, as_of=day, outlier_window=WEEK, ml_window=WEEK)
        if report.errors:
            raise RuntimeError(f"cycle {cycle}: {report.errors}")
    return store


@query()
def run_monitor_cycle(t):
    """Metrics written by two monitoring cycles over the stored readings."""
    return monitored(t).metrics().select("metric_id", "metric_name", "metric_value", "metric_unit", "recorded_at")


@query(
    f"""select c.cycle, 'predictions_generated' as metric_name, count(r.record_id)::double as metric_value
        from (values (1::bigint, 1), (2::bigint, 0)) c(cycle, back) left join labelled r
          on r.ts >= (select max(ts) from readings) - to_days(c.back) - interval '7' day
          and r.data_quality_score > cast(0.7 as double) and r.pm25 is not null and r.co2_ppm is not null group by c.cycle
        union all select cycle, 'total_cycles', cycle::double from (values (1::bigint), (2::bigint)) c(cycle)""",
    "readings labelled",
)
def monitor_cycle_counts(t):
    """Predictions and cycles that two monitoring cycles have counted."""
    found = monitored(t).metrics().where(F.col("metric_name").isin("predictions_generated", "total_cycles"))
    return found.select(F.col("batch_id").alias("cycle"), "metric_name", "metric_value")


@query()
def monitor_anomalies(t):
    """Both detectors of the monitor and the alerts they lead to."""
    return alerts.anomaly_alerts(detect_anomalies(gated_week(t)))


ZONE_WINDOWS = """, steps as (select s.city_zone, date_trunc('minute', r.ts) as step, count(*) as n, sum(r.pm25) as p,
         count(r.pm25) as k, max(r.pm25) as m
         from readings r join stations s on r.station_id = s.station_id group by 1, 2),
       moved as (select *, step - to_minutes(o) as window_start from steps, (select unnest(range(60)) as o))
       select window_start, window_start + interval '60' minute as window_end, city_zone, cast(sum(n) as bigint) as readings,
         round(case when sum(k) > 0 then sum(p) / sum(k) end, 6) as avg_pm25, max(m) as max_pm25
       from moved group by 1, 3"""


@query(ZONE_WINDOWS, "readings stations")
def zone_windows(t):
    located = t.readings.join(t.stations.select("station_id", "city_zone"), "station_id")
    return rounded(series.zone_windows(located), "avg_pm25")


@query(
    f"""{ZONE_WINDOWS}
       having window_start + interval '60' minute <= (select date_trunc('millisecond', max(ts)) from readings) - interval '2' minute""",
    "readings stations",
)
def stream_zone_windows_query(t):
    """The windows the stream has closed once all events are read: those the watermark has passed."""
    target = scratch_path(t.spark, "zones")
    stream = readings_from_events(streamed_events(t)).select("station_id", "ts", "pm25")
    run_to_end(stream_zone_windows(stream, t.stations), target)
    return rounded(t.spark.read.parquet(target), "avg_pm25")


def zone_store(t: TestTables) -> Store:
    """A store after four files of readings of all times went through the zone stream, so most come late."""
    store = Store(t.spark, scratch_path(t.spark, "zone-store"))
    t.stations.withColumn("batch_id", F.lit(0)).write.partitionBy("batch_id").parquet(store.path("stations"))
    in_four_batches(
        t,
        lambda readings: run_zone_stream(
            t.spark, readings.select("station_id", "ts", "pm25"), store, trigger={"availableNow": True}, compact_every=2
        ),
    )
    return store


@query(ZONE_WINDOWS, "readings stations")
def run_zone_stream_windows(t):
    """Stored windows after late readings equal those over all readings."""
    return rounded(zone_store(t).zone_windows(), "avg_pm25")


@query(
    """, parts as (select record_id % 4 as part, ts from readings r join stations s on r.station_id = s.station_id),
         seen as (select part, (select max(ts) from parts b where b.part < a.part) as newest from (select distinct part from parts) a)
       select part as batch_id, count(*) as arrived, count(case when ts < newest - interval '2' minute then 1 end) as late
       from parts join seen using (part) group by 1""",
    "readings stations",
)
def run_zone_stream_late(t):
    """Readings of each batch that came more than two minutes behind the newest of the batches before."""
    return zone_store(t).zone_log().select("batch_id", "arrived", "late")


for _name in ("scan_readings", "write_partitioned", "stream_readings", "append_readings", "impute_median",
              "run_ingest_stream", "stream_zone_windows"):
    # Functions whose name is taken by the operator they run.
    QUERIES[_name] = QUERIES.pop(f"{_name}_query")
    ORACLE[_name] = ORACLE.pop(f"{_name}_query")
