"""Removal of long repeated byte strings, found by bounded interval expansion on a Burrows-Wheeler transform.

Every window of ``length`` bytes is handed to one of its substrings, its anchor: the one with the least hash. Equal
windows have equal anchors, so windows are only compared below the same anchor, and only where an anchor is
found twice. The windows of one anchor are one stretch of text, its context. Equal contexts are put
together, different ones below one anchor go into a transform.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from aerolens.llm.common import id_key, prepared
from aerolens.llm.shingles import FACTOR, mixed
from aerolens.session import materialized

#: Windows of a text whose anchors are looked for at once; below 2 ** 21 with the rest of the last window.
BLOCK = 1 << 20
PLACE = np.uint64((1 << 21) - 1)
#: Bytes that go into one transform, unless one anchor has more.
TRANSFORM_BYTES = 1 << 19
#: Different contexts below one anchor from which they are cut up before they are compared.
HOT = 2000
#: Bytes of an anchor. Long ones are seldom found in lines and phrases that are shorter than a window.
GRAM = 100
#: Windows of a cut context.
CUT = 16
#: Bits of the map that keeps most anchors found once from being handed on.
MAP_BITS = 1 << 25


# --- the transform ---


def repeated_windows(contexts: Sequence[bytes], length: int) -> list[np.ndarray]:
    """For each context, which of its windows of ``length`` bytes also start elsewhere in the contexts.

    Suffixes are sorted by their first ``length`` bytes. The expansion begins with the interval of
    all suffixes and goes on, one byte to the left at a time and all intervals of a depth together. An interval
    that ends where no common prefix is known yet settles it as the depth before, so they come in
    increasing order; what is not settled at ``length`` is at least that long.
    """
    sizes = np.array([len(c) for c in contexts])
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    joined = b"\0".join(contexts) + b"\0"
    count = len(joined)
    text = np.frombuffer(joined, dtype=np.uint8).astype(np.int16) + 1
    text[ends - 1] = 0  # ends a context, and is no byte; windows do not reach over it
    order = _sorted_suffixes(text, length)
    before = text[order - 1]  # the transform
    # Where the transform's places lie among the suffixes that begin with their byte.
    by_byte = np.argsort(before, kind="stable")
    leads_to = np.empty(count, dtype=np.int64)
    leads_to[by_byte] = np.arange(count)
    first = np.full(count, -1, dtype=np.int64)  # previous place of the same byte
    last = np.full(count, count, dtype=np.int64)  # next one
    same = before[by_byte[1:]] == before[by_byte[:-1]]
    first[by_byte[1:][same]] = by_byte[:-1][same]
    last[by_byte[:-1][same]] = by_byte[1:][same]

    common = np.full(count + 1, -1, dtype=np.int32)
    common[0] = common[count] = 0
    low, high = np.array([0]), np.array([count])
    for depth in range(length):
        if not len(low):
            break
        widths = high - low
        places = np.repeat(low - np.cumsum(widths) + widths, widths) + np.arange(widths.sum())
        begin, end = np.repeat(low, widths), np.repeat(high, widths)
        opens = places[first[places] < begin]
        closes = places[last[places] >= end]
        # The new intervals do not overlap, so their sorted ends belong together.
        low, high = np.sort(leads_to[opens]), np.sort(leads_to[closes]) + 1
        fresh = common[high] < 0
        low, high = low[fresh], high[fresh]
        common[high] = depth
    long = common < 0
    twice = np.zeros(count, dtype=bool)
    twice[order[long[:-1] | long[1:]]] = True
    return [twice[a : a + max(0, n - length + 1)] for a, n in zip(starts, sizes)]


def _sorted_suffixes(text: np.ndarray, length: int) -> np.ndarray:
    """Starts in the order of the ``length`` or more symbols from there, by doubling; the end leads to the start."""
    count = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank, known = rank.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while known < length:
        key = rank * count + np.roll(rank, -known)
        order = np.argsort(key, kind="stable")
        steps = np.diff(key[order]) != 0
        rank[order] = np.concatenate([[0], np.cumsum(steps)])
        known *= 2
        if steps.all():
            break
    return order


# --- anchors ---


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` bytes, put together from runs of powers of two."""
    parts, power, width = [], data.astype(np.uint64) + np.uint64(1), 1
    rest = size
    while rest:
        if rest & 1:
            parts.append((power, width))
        rest >>= 1
        if rest:
            power = power[:-width] * np.uint64(pow(FACTOR, width, 1 << 64)) + power[width:]
            width *= 2
    count, offset = len(data) - size + 1, 0
    total = np.zeros(count, dtype=np.uint64)
    for hashes, width in parts:
        total = total * np.uint64(pow(FACTOR, width, 1 << 64)) + hashes[offset : offset + count]
        offset += width
    return mixed(total)


def _sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while width * 2 <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[: len(values) - (size - width)], values[size - width :]) if size > width else values


def anchors(data: bytes, length: int, gram: int):
    """Blocks of arrays: anchor hash, its place, and the first and last window that it stands for.

    A window's anchor is the first of its runs of ``gram`` bytes with the least hash.
    """
    whole = np.frombuffer(data, dtype=np.uint8)
    for begin in range(0, len(whole) - length + 1, BLOCK):
        part = whole[begin : begin + BLOCK + length - 1]
        hashes = _grams(part, gram)
        least = _sliding_least((hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)
        place = (least & PLACE).astype(np.int64)
        change = np.flatnonzero(np.diff(place)) + 1
        first = np.concatenate([[0], change])
        last = np.concatenate([change, [len(place)]]) - 1
        yield hashes[place[first]], begin + place[first], begin + first, begin + last


def _bytes(value) -> bytes:
    return (value.as_py() or "").encode("utf-8", "surrogatepass")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {
        "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "string": pa.string(),
    }
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields]
    )


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


# --- the job ---


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id, row, text``: rows of one id with different texts are kept apart by the hash of their text."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(id_key(id_column).alias("id"), F.xxhash64(text).alias("row"), text.alias("text"))


def _repeated_anchors(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def work(arrived):
        for batch in arrived:
            found = [h for value in batch.column(0) for h, *_ in anchors(_bytes(value), length, gram)]
            found, times = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times.astype(np.int64))], ["anchor", "n"])

    counted = rows.select("text").mapInArrow(work, "anchor bigint, n bigint")
    return materialized(
        counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "anchors"
    )


def _contexts(rows: DataFrame, repeated: DataFrame, length: int, gram: int) -> DataFrame:
    """Where repeated anchors lie: ``anchor, context`` (a hash), ``id, row, start, windows``.

    A map of bits of fixed size drops most other anchors where texts are read, a join drops the rest.
    """
    bit = f"cast(anchor & {MAP_BITS - 1} as int)"
    parts = repeated.selectExpr(f"{bit} div 64 as word", f"shiftleft(1L, {bit} % 64) as bits").groupBy("word").agg(
        F.expr("bit_or(bits)").alias("bits")
    ).toPandas()
    table = np.zeros(MAP_BITS // 64, dtype=np.int64)
    table[parts["word"].to_numpy(np.int64)] = parts["bits"].to_numpy(np.int64)
    shared = rows.sparkSession.sparkContext.broadcast(table.view(np.uint64))
    schema = "anchor bigint, context bigint, id bigint, row bigint, start bigint, windows bigint"

    def work(arrived):
        marks = shared.value
        for batch in arrived:
            out = []
            for key, row, value in zip(*(batch.column(i) for i in range(3))):
                key, row, data = key.as_py(), row.as_py(), _bytes(value)
                for hashes, places, firsts, lasts in anchors(data, length, gram):
                    at = hashes & np.uint64(MAP_BITS - 1)
                    some = np.flatnonzero((marks[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1))
                    for i in some.tolist():
                        first, last = int(firsts[i]), int(lasts[i])
                        digest = xxhash.xxh3_64_intdigest(data[first : last + length], seed=int(places[i]) - first)
                        out.append((_signed(int(hashes[i])), _signed(digest), key, row, first, last - first + 1))
            yield _batch(out, schema)

    return materialized(rows.mapInArrow(work, schema).join(repeated, "anchor", "left_semi"), "contexts")


TEXTS = "hot bigint, anchor bigint, context bigint, at bigint, windows bigint, core bigint, data binary"


def _texts_of(rows: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """The bytes of one occurrence of each wanted context, and those of hot anchors already cut up.

    So the texts are shuffled once for both. See ``_cut_up`` for ``at, windows, core``.
    """
    names = ("anchor", "context", "start", "windows", "hot")
    lists = wanted.groupBy("id", "row").agg(*(F.collect_list(c).alias(c) for c in names))

    def work(arrived):
        for batch in arrived:
            columns = [batch.column(i) for i in range(8)]
            out, seen = [], set()
            for key, row, value, *parts in zip(*columns):
                # Rows given many times need not hand on the same contexts again and again.
                if (key.as_py(), row.as_py()) in seen:
                    continue
                seen.add((key.as_py(), row.as_py()))
                text = _bytes(value)
                for anchor, context, start, windows, hot in zip(*(p.as_py() for p in parts)):
                    data = text[start : start + windows + length - 1]
                    if hot:
                        out.extend((1, anchor, context, *part) for part in _groups(data, anchor, length, gram))
                    else:
                        out.append((0, anchor, context, 0, windows, 0, data))
            yield _batch(out, TEXTS)

    return materialized(rows.join(lists, ["id", "row"]).select("id", "row", "text", *names).mapInArrow(work, TEXTS), "texts")


def _groups(data: bytes, anchor: int, length: int, gram: int):
    """``at, windows, core, data`` of each group of ``CUT`` windows, counted from the anchor.

    So equal windows are in equal groups. The core is what all windows of a whole group hold.
    """
    windows = len(data) - length + 1
    hashes = _grams(np.frombuffer(data, dtype=np.uint8), gram)
    place = int(np.flatnonzero(hashes.view(np.int64) == anchor)[0])
    at = 0
    while at < windows:
        group = (place - at) // CUT
        latest = place - group * CUT
        stop = min(windows, latest + 1)
        core = xxhash.xxh3_64_intdigest(data[latest : latest - (CUT - 1) + length], seed=group & 0xFFFF)
        yield at, stop - at, _signed(core), data[at : stop - 1 + length]
        at = stop


def _compared(texts: DataFrame, length: int) -> DataFrame:
    """``anchor, context, runs``: stretches of repeated windows, found by transforms over whole anchors."""
    schema = "anchor bigint, context bigint, runs array<bigint>"

    def work(arrived):
        held: dict[int, dict[int, bytes]] = {}
        size, current = 0, None

        def out():
            keys = [(a, c) for a, contexts in held.items() for c in contexts]
            flags = repeated_windows([held[a][c] for a, c in keys], length) if keys else []
            rows = []
            for (a, c), flag in zip(keys, flags):
                edges = np.flatnonzero(np.diff(np.concatenate([[False], flag, [False]]).astype(np.int8)))
                if len(edges):
                    rows.append((a, c, edges))
            held.clear()
            return _batch(rows, schema)

        for batch in arrived:
            for anchor, context, data in zip(*(c.to_pylist() for c in batch.columns)):
                if anchor != current and size >= TRANSFORM_BYTES:
                    yield out()
                    size = 0
                current = anchor
                if context not in held.setdefault(anchor, {}):
                    held[anchor][context] = data
                    size += len(data) + 1
        yield out()

    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return texts.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(work, schema)


def _cut_up(groups: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts, without bringing an anchor's contexts together.

    Contexts come cut into groups of ``CUT`` windows. All windows of a group hold the group's core, so groups
    whose core is found once have no repeated window; this drops what differs between the contexts. The windows of
    the others are counted by their hashes.
    """
    hashes = "anchor bigint, context bigint, at bigint, h1 bigint, h2 bigint"

    def split(arrived):
        for batch in arrived:
            out = []
            for anchor, context, at, windows, data in zip(*(c.to_pylist() for c in batch.columns)):
                for i in range(windows):
                    digest = xxhash.xxh3_128_intdigest(data[i : i + length])
                    out.append((anchor, context, at + i, _signed(digest >> 64), _signed(digest & (2**64 - 1))))
            yield _batch(out, hashes)

    shared = materialized(groups.groupBy("anchor", "core").count().where("count > 1").drop("count"), "shared-cores")
    some = groups.join(shared, ["anchor", "core"]).select("anchor", "context", "at", "windows", "data")
    windows = materialized(some.mapInArrow(split, hashes), "windows")
    twice = materialized(windows.groupBy("h1", "h2").count().where("count > 1").drop("count"), "repeated-windows")
    found = windows.join(twice, ["h1", "h2"]).groupBy("anchor", "context").agg(F.collect_list("at").alias("at"))
    return found.select(
        "anchor", "context", F.flatten(F.transform("at", lambda x: F.array(x, x + 1))).alias("runs")
    )


def suffix_dedup(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", length: int = 200, gram: int = GRAM
) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also starts anywhere else.

    Texts are taken as UTF-8 and never joined; overlapping occurrences and those in the same text count,
    and all are judged on the input. Returns one row per input row: the id, ``kept`` (binary, what is left),
    ``n_bytes``, ``n_removed`` and ``n_spans`` (runs of removed bytes).

    A null text is empty; texts under ``length`` bytes stay as they are. Rows given twice are copies of
    each other. A null id is one id above all others.
    """
    prepared(docs.sparkSession)
    rows = _rows(docs, id_column, text_column)
    repeated = _repeated_anchors(rows, length, gram)
    places = _contexts(rows, repeated, length, gram)
    distinct = materialized(
        places.groupBy("anchor", "context").agg(
            F.count("*").alias("n"), F.min(F.struct("id", "row", "start", "windows")).alias("one")
        ), "distinct",
    )
    sizes = materialized(
        distinct.groupBy("anchor").agg(F.count("*").alias("many")).where("many > 1"), "mixed"
    )
    hot = (F.col("many") > HOT).cast("bigint").alias("hot")
    wanted = distinct.join(sizes, "anchor").select("anchor", "context", hot, "one.*")
    texts = _texts_of(rows, wanted, length, gram)
    usual = _compared(texts.where("hot = 0").select("anchor", "context", "data"), length)
    found = usual.unionByName(_cut_up(texts.where("hot = 1").drop("hot"), length))
    copies = distinct.where("n > 1").selectExpr("anchor", "context", "array(0L, one.windows) as runs")
    runs = materialized(found.unionByName(copies), "runs")
    # A set, as a row given many times has its places as often.
    spans = (
        places.join(runs, ["anchor", "context"])
        .groupBy("id", "row")
        .agg(F.flatten(F.collect_set(F.transform("runs", lambda x: x + F.col("start")))).alias("edges"))
    )

    schema = "id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint"

    def cut(arrived):
        for batch in arrived:
            out = []
            for key, value, edges in zip(*(batch.column(i) for i in range(3))):
                data, edges = _bytes(value), edges.as_py() or []
                change = np.zeros(len(data) + 1, dtype=np.int64)
                np.add.at(change, np.array(edges[::2], dtype=np.int64), 1)
                np.add.at(change, np.array(edges[1::2], dtype=np.int64) + length - 1, -1)
                gone = np.cumsum(change)[:-1] > 0
                kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
                spans = int(np.count_nonzero(np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1))
                out.append((key.as_py(), kept, len(data), int(gone.sum()), spans))
            yield _batch(out, schema)

    whole = rows.join(spans.hint("shuffle_hash"), ["id", "row"], "left").select("id", "text", "edges")
    return whole.mapInArrow(cut, schema).select(
        F.when(F.col("id") != 2**63 - 1, F.col("id")).alias(id_column), "kept", "n_bytes", "n_removed", "n_spans"
    )
