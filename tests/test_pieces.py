"""Compaction and the key index: every row once after any lost step, bounded pieces, exact look-ups."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerolens.schema import READINGS
from aerolens.plans.store import Store
from aerolens.session import scratch_path
from aerolens.sources import folders, pieces
from aerolens.sources.pieces import all_pieces, compact, live_pieces, read_index, sweep
from aerolens.sources.tables import DAY, append_readings, latest_ts, read_readings, scan_readings, with_partition
from aerolens.streaming.ingest import admit_batch, process_batch

AT = dt.datetime(2024, 1, 1, 23, 50)


def batch_of(frame, number, rows=5):
    """Readings of one batch, over two days from batch to batch."""
    return frame(*[{"record_id": number * rows + i, "ts": AT + dt.timedelta(minutes=number * rows + i)} for i in range(rows)])


def ids(df):
    return sorted(r.record_id for r in df.select("record_id").collect())


def filled(spark, frame, batches, store=None):
    store = store or Store(spark, scratch_path(spark, "pieces"), "day")
    for number in batches:
        store.append_readings(batch_of(frame, number), number)
    return store



def test_pieces_stay_few_and_rows_whole(spark, frame):
    store = Store(spark, scratch_path(spark, "pieces"), "day")
    path, most = store.path("readings"), 0
    for number in range(21):
        filled(spark, frame, [number], store)
        store.compact(number, fan=4, grace=0)
        live = live_pieces(all_pieces(spark, path))
        most = max(most, len(live))
        assert sum(p.high - p.low + 1 for p in live) == number + 1
    assert most <= 4 + 3 + 1 + 1
    assert [(p.low, p.high) for p in live] == [(0, 15), (16, 19), (20, 20)]
    assert ids(read_readings(spark, path)) == list(range(105))
    table = read_readings(spark, path)
    assert {(r.record_id // 5, r.batch_id) for r in table.collect()} == {(i, i) for i in range(21)}
    assert {(r.ts.day, r[DAY] % 100) for r in table.collect()} == {(1, 1), (2, 2)}
    # What was replaced is gone, and folders of days without batches too.
    assert len(folders.matching(spark, f"{path}/{DAY}=*/batch_id=*")) == 1
    assert len(folders.matching(spark, f"{path}/_merged/*")) == 2 and len(folders.matching(spark, f"{path}/_index/*")) == 3
    assert store.latest() == AT + dt.timedelta(minutes=104)
    window = store.readings(9, columns=["record_id"])
    assert ids(window) == list(range(95, 105))


@pytest.mark.parametrize("step", ["written without mark", "index missing", "mark set, nothing removed", "half removed"])
def test_a_run_lost_at_any_step(spark, frame, monkeypatch, step):
    store = filled(spark, frame, range(5))
    path = store.path("readings")
    if step == "written without mark":
        read_readings(spark, path).limit(3).write.partitionBy(DAY).parquet(f"{path}/_merged/range=0_3")
        folders.remove(spark, f"{path}/_merged/range=0_3/_SUCCESS")
    elif step == "index missing":
        monkeypatch.setattr(pieces, "write_index", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.compact(5, fan=4, grace=0)
        monkeypatch.undo()
    elif step == "mark set, nothing removed":
        store.compact(5, fan=4, grace=3600)
    else:
        removed = []

        def some(session, folder):
            if len(removed) == 2:
                raise RuntimeError("lost")
            removed.append(folder)
            real(session, folder)

        real = folders.remove
        monkeypatch.setattr(folders, "remove", some)
        with pytest.raises(RuntimeError):
            store.compact(5, fan=4, grace=0)
        monkeypatch.undo()
    assert ids(read_readings(spark, path)) == list(range(25))
    assert admit_batch(store, batch_of(frame, 2), 9).count() == 0
    store.compact(5, fan=4, grace=0)
    sweep(spark, path, 0)
    assert ids(read_readings(spark, path)) == list(range(25))
    assert [(p.low, p.high) for p in all_pieces(spark, path)] == [(0, 3), (4, 4)]


def test_a_reader_goes_on_while_batches_are_put_together(spark, frame):
    store = filled(spark, frame, range(5))
    reading = read_readings(spark, store.path("readings"))
    store.compact(5, fan=4, grace=3600)
    assert ids(reading) == list(range(25))
    assert ids(read_readings(spark, store.path("readings"))) == list(range(25))


def test_last_batch_may_be_repeated_a_merged_one_not(spark, frame):
    store = filled(spark, frame, range(5))
    store.compact(5, fan=4, grace=0)
    store.append_readings(batch_of(frame, 4).limit(2), 4)
    assert len(ids(store.all_readings())) == 22
    with pytest.raises(ValueError, match="merged"):
        append_readings(batch_of(frame, 2), store.path("readings"), 2)


def test_empty_batches_and_bulk_rows(spark, frame):
    store = Store(spark, scratch_path(spark, "pieces"), "day")
    store.load_readings(batch_of(frame, 0, 40))
    for number in range(9):
        store.append_readings(batch_of(frame, 10 + number).where("false" if number % 2 else "true"), number)
    store.compact(9, fan=4, grace=0)
    assert ids(store.all_readings()) == sorted([*range(40), *(i for n in range(0, 9, 2) for i in range(50 + 5 * n, 55 + 5 * n))])
    assert (-1, -1) in [(p.low, p.high) for p in live_pieces(all_pieces(spark, store.path("readings")))]
    assert admit_batch(store, batch_of(frame, 3), 9).count() == 0


def keys(df):
    return [] if df is None else sorted((r.record_id, r.ts) for r in df.collect())


@pytest.mark.parametrize("per_word", [pieces.KEYS_PER_WORD, 100_000])
def test_look_ups_are_exact(spark, frame, monkeypatch, per_word):
    """Also with filters of one word, which let nearly every key pass."""
    monkeypatch.setattr(pieces, "KEYS_PER_WORD", per_word)
    store = Store(spark, scratch_path(spark, "pieces"), "day")
    even = [{"record_id": 2 * i, "ts": AT + dt.timedelta(minutes=i)} for i in range(120)]
    for number in range(6):
        store.append_readings(frame(*even[20 * number : 20 * number + 20]), number)
    store.compact(6, fan=4, grace=0)
    # The same ids at the same times, at other times, and ids between them.
    asked = with_partition(frame(*even[::7], *[{**e, "ts": e["ts"] + dt.timedelta(seconds=1)} for e in even[::5]],
                                 *[{**e, "record_id": e["record_id"] + 1} for e in even]))
    days = [r[0] for r in asked.select(DAY).distinct().collect()]
    found = store.known_keys(asked, days, but_batch=99)
    assert keys(found) == sorted((e["record_id"], e["ts"]) for e in even[::7])
    # Rows of the batch itself do not count.
    own = with_partition(frame(*even[100:]))
    assert keys(store.known_keys(own, days, but_batch=5)) == []


def test_new_ids_open_no_stored_row(spark, frame, monkeypatch):
    store = filled(spark, frame, range(6))
    monkeypatch.setattr(pieces, "read_pieces", lambda *_: pytest.fail("a piece was opened"))
    asked = with_partition(batch_of(frame, 7))
    days = [r[0] for r in asked.select(DAY).distinct().collect()]
    assert store.known_keys(asked, days, but_batch=7) is None
    # Ids between the stored ones are left out by the filters.
    between = with_partition(frame(*[{"record_id": 12, "ts": AT + dt.timedelta(minutes=12, seconds=s)} for s in range(1, 30)]))
    assert store.known_keys(between, [20240102], but_batch=7) is None


def test_pieces_without_index_are_read(spark, frame):
    store = filled(spark, frame, range(3))
    folders.remove(spark, f"{store.path('readings')}/_index/1_1")
    assert read_index(spark, store.path("readings"), live_pieces(all_pieces(spark, store.path("readings"))))[1][0].low == 1
    assert admit_batch(store, batch_of(frame, 1), 9).count() == 0
    assert latest_ts(spark, store.path("readings")) == AT + dt.timedelta(minutes=14)


def test_a_filter_has_no_false_negative(spark):
    rows = spark.range(30_000).selectExpr(
        f"cast(20240101 + id % 3 as int) as {DAY}", "id * 7919 as record_id", "timestamp_micros(id * 1000003) as ts"
    )
    index = pieces.index_rows(rows)
    days = index.where("word = -1")
    assert {r.n for r in days.collect()} == {10_000} and {r.words for r in days.collect()} == {4096}
    placed = rows.join(days.select(DAY, "words"), DAY).select(DAY, F.expr(f"pmod({pieces._hash(1)}, words)").alias("word"), F.expr(pieces.MASK).alias("mask"))
    passed = placed.join(index.where("word >= 0").select(DAY, "word", "bits"), [DAY, "word"]).where("(bits & mask) = mask")
    assert passed.count() == 30_000
    others = spark.range(30_000).selectExpr(
        f"cast(20240101 + id % 3 as int) as {DAY}", "id * 7919 + 1 as record_id", "timestamp_micros(id * 1000003) as ts"
    )
    placed = others.join(days.select(DAY, "words"), DAY).select(DAY, F.expr(f"pmod({pieces._hash(1)}, words)").alias("word"), F.expr(pieces.MASK).alias("mask"))
    passed = placed.join(index.where("word >= 0").select(DAY, "word", "bits"), [DAY, "word"]).where("(bits & mask) = mask")
    assert passed.count() < 1500


def test_key_is_id_and_time_and_counts_are_kept(spark, frame):
    store = Store(spark, scratch_path(spark, "keys"), "day")
    first = [{"record_id": i, "ts": AT + dt.timedelta(seconds=i)} for i in range(25)]
    assert process_batch(store, frame(*first, *first[:3], {"humidity": 101.0}), 0) == 25
    later = [{"record_id": 3, "ts": AT + dt.timedelta(seconds=50)}, {"record_id": 3, "ts": AT - dt.timedelta(days=1)}]
    assert process_batch(store, frame(*later, *first[5:9]), 1) == 2
    log = {r.batch_id: (r.arrived, r.rejected, r.known, r.stored) for r in store.ingest_log().collect()}
    assert log == {0: (29, 1, 3, 25), 1: (6, 0, 4, 2)}
    assert store.all_readings().where("record_id = 3").count() == 3
    assert scan_readings(spark, store.path("readings"), minutes=1).count() > 20
    assert compact(spark, store.path("readings"), READINGS, 1, fan=4) == []
