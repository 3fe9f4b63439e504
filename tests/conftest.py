import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

DATA = Path(os.environ.get("TEST_DATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("aerolens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from aerolens.session import configure

    yield configure(session)
    session.stop()


@pytest.fixture
def small(spark):
    from aerolens.sources.testviews import TestTables

    return TestTables(spark, str(DATA / "sf0.001"))


@pytest.fixture
def medium(spark):
    from aerolens.sources.testviews import TestTables

    return TestTables(spark, str(DATA / "sf0.01"))


READING = {
    "record_id": "bigint", "station_id": "bigint", "ts": "timestamp", "pm25": "double", "co2_ppm": "double",
    "pm10": "double", "no2_ppm": "double", "o3_ppm": "double", "temperature_c": "double", "humidity": "double",
    "wind_speed": "double", "wind_direction": "double", "atmospheric_pressure": "double",
    "data_quality_score": "double",
}


@pytest.fixture
def frame(spark):
    """Readings from dictionaries; what is left out gets a plain value."""
    import datetime as dt

    plain = {
        "station_id": 1, "pm25": 10.0, "co2_ppm": 450.0, "pm10": 12.0, "no2_ppm": 0.01, "o3_ppm": 0.02,
        "temperature_c": 20.0, "humidity": 50.0, "wind_speed": 1.0, "wind_direction": 90.0,
        "atmospheric_pressure": 1010.0, "data_quality_score": 0.9,
    }

    def make(*rows):
        full = []
        for i, row in enumerate(rows):
            base = plain | {"record_id": i, "ts": dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)}
            full.append(tuple((base | row)[name] for name in READING))
        return spark.createDataFrame(full, ", ".join(f"{n} {k}" for n, k in READING.items()))

    return make
