"""How the events arrive for the streams of the queries."""

from aerolens.plans import queries
from aerolens.sources.tables import stream_readings


def test_a_micro_batch_lands_in_many_files(small, monkeypatch):
    files = []

    def landed(spark, landing, *args, **options):
        files.append(spark.read.parquet(landing).select("_metadata.file_path").distinct().count())
        return stream_readings(spark, landing, *args, **options)

    monkeypatch.setattr(queries, "stream_readings", landed)
    store = queries.zone_store(small)
    each = small.spark.sparkContext.defaultParallelism
    assert each > 1 and files == [each * (part + 1) for part in range(4)]
    counted = {r["batch_id"]: r["arrived"] for r in store.zone_log().collect()}
    known = small.readings.join(small.stations, "station_id").selectExpr("record_id % 4 as part").groupBy("part").count()
    assert counted == {r["part"]: r["count"] for r in known.collect()}
