"""A table as pieces: batches as they came, batches put together, and an index of their keys.

Each append is a piece of its own, ``ts_day=D/batch_id=N``. ``compact`` puts the pieces of every ``FAN`` batches together, and
those again, so a table has a bounded number of pieces on each level and a row is rewritten once a level. A merged piece
lies in ``_merged/range=LOW_HIGH`` and counts from the moment Spark marks it a success, which it does last; from then on the
pieces inside its range do not. So readers, who go by ``live_pieces``, see every row once whatever step a run was lost at.
What no longer counts is removed after a time of grace for jobs that still read it.

``_index/LOW_HIGH`` holds, for each day of a piece, the range of its ids and times, and a Bloom filter of its keys as rows of
64-bit words. It is looked up before a piece's keys are read; a piece without index has its keys read.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from aerolens.schema import fields
from aerolens.sources import folders

DAY = "ts_day"
#: So many pieces are put together at once.
FAN = 20
MERGED, INDEX = "_merged", "_index"
#: Seconds for which replaced pieces stay readable.
GRACE = 3600
KEY = ["record_id", "ts"]
#: Keys for each 64-bit word of a filter, about, and bits that a key sets in its word.
KEYS_PER_WORD, KEY_BITS = 4, 5
#: A row with ``word`` -1 tells about a day; the others are words of its filter.
INDEX_ROWS = fields(
    f"{DAY} int, word bigint, bits bigint, n bigint, words bigint, low_id bigint, high_id bigint, low_ts timestamp, high_ts timestamp"
)


@dataclass(frozen=True, order=True)
class Piece:
    """The rows of the batches from ``low`` to ``high``; ``paths`` are its folders."""

    low: int
    high: int
    paths: tuple[str, ...]

    @property
    def merged(self) -> bool:
        return f"/{MERGED}/" in self.paths[0]

    @property
    def name(self) -> str:
        return f"{self.low}_{self.high}"

    def inside(self, low: int, high: int) -> bool:
        return low <= self.low and self.high <= high


def _merged_path(path: str, low: int, high: int) -> str:
    return f"{path}/{MERGED}/range={low}_{high}"


def _range(name: str) -> tuple[int, int]:
    low, high = name.rpartition("=")[2].split("_")
    return int(low), int(high)


def merged_ranges(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """The ranges of batches that are completely put together."""
    return sorted(_range(mark.split("/")[-2]) for mark in folders.matching(spark, f"{path}/{MERGED}/range=*/_SUCCESS"))


def all_pieces(spark: SparkSession, path: str, since_day: int | None = None, days: list[int] | None = None) -> list[Piece]:
    """Complete pieces, also those that others have replaced; of batches only the folders of the given days."""
    root = path.rstrip("/")
    found = [Piece(low, high, (_merged_path(root, low, high),)) for low, high in merged_ranges(spark, root)]
    batches: dict[int, list[str]] = {}
    patterns = [f"{DAY}={day}" for day in days] if days is not None else [f"{DAY}=*"]
    for pattern in patterns:
        for folder in folders.matching(spark, f"{root}/{pattern}/batch_id=*"):
            day, batch = (part.rpartition("=")[2] for part in folder.split("/")[-2:])
            if since_day is None or not day.isdigit() or int(day) >= since_day:
                batches.setdefault(int(batch), []).append(folder)
    return found + [Piece(batch, batch, tuple(paths)) for batch, paths in batches.items()]


def live_pieces(pieces: list[Piece]) -> list[Piece]:
    """The pieces that no larger one has replaced; of a batch put together alone, the merged piece."""
    merged = [p for p in pieces if p.merged]
    return sorted(
        p for p in pieces
        if not any(p.inside(m.low, m.high) and m is not p and ((m.low, m.high) != (p.low, p.high) or not p.merged) for m in merged)
    )


def read_pieces(spark: SparkSession, path: str, schema: T.StructType, pieces: list[Piece]) -> DataFrame:
    """The rows of some pieces with ``ts_day`` and ``batch_id``."""
    full = T.StructType(schema.fields + fields(f"{DAY} int, batch_id bigint").fields)
    batches = [folder for p in pieces if not p.merged for folder in p.paths]
    merged = [p.paths[0] for p in pieces if p.merged]
    frames = []
    if batches:
        frames.append(spark.read.schema(full).option("basePath", path).parquet(*batches))
    if merged:
        ranged = T.StructType([*full.fields, T.StructField("range", T.StringType())])
        frames.append(spark.read.schema(ranged).option("basePath", f"{path}/{MERGED}").parquet(*merged).drop("range"))
    if not frames:
        return spark.createDataFrame([], full)
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1].select(*frames[0].columns))


def check_not_merged(spark: SparkSession, path: str, batch_id: int) -> None:
    """A batch that was put together with others cannot be written again; a stream repeats its last batch only."""
    if any(low <= batch_id <= high for low, high in merged_ranges(spark, path)):
        raise ValueError(f"batch {batch_id} of {path} has been merged and cannot be written again")


def compact(
    spark: SparkSession, path: str, schema: T.StructType, below: int, *, fan: int = FAN, grace: float = GRACE, index: bool = False
) -> list[tuple[int, int]]:
    """Put together the batches below ``below``, level by level, and remove what was replaced ``grace`` seconds ago.

    Ranges are aligned, so a run that was lost is repeated by the next with the same result. Returns the ranges written.
    """
    made, size = [], fan
    pieces = all_pieces(spark, path)
    while True:
        live = [p for p in live_pieces(pieces) if p.low >= 0]
        wanted = sorted({p.low // size * size for p in live if p.high < below and p.high - p.low + 1 < size})
        wanted = [low for low in wanted if low + size <= below]
        for low in wanted:
            high = low + size - 1
            inside = [p for p in live if p.inside(low, high)]
            target = _merged_path(path, low, high)
            rows = read_pieces(spark, path, schema, inside)
            (
                rows.hint("rebalance", DAY).sortWithinPartitions(DAY, *[c for c in ("station_id", "ts") if c in rows.columns])
                .write.mode("overwrite").partitionBy(DAY).parquet(target)
            )
            piece = Piece(low, high, (target,))
            if index:
                write_index(spark, path, schema, piece)
            pieces.append(piece)
            made.append((low, high))
        if not any(p.high - p.low + 1 >= size for p in live_pieces(pieces)) or size > below:
            break
        size *= fan
    sweep(spark, path, grace)
    return made


def sweep(spark: SparkSession, path: str, grace: float = GRACE) -> None:
    """Remove pieces that were replaced at least ``grace`` seconds ago."""
    pieces = all_pieces(spark, path)
    live, now = set(live_pieces(pieces)), time.time()
    for piece in pieces:
        if piece in live:
            continue
        over = next(p for p in live if p.merged and piece.inside(p.low, p.high))
        if now - folders.modified(spark, f"{over.paths[0]}/_SUCCESS") >= grace:
            # A merged piece stops counting with its mark; a batch's folders are under the larger piece already.
            if piece.merged:
                folders.remove(spark, f"{piece.paths[0]}/_SUCCESS")
            for folder in piece.paths:
                folders.remove(spark, folder)
                if not piece.merged:
                    folders.remove_if_empty(spark, folder.rpartition("/")[0])
            if (piece.low, piece.high) != (over.low, over.high):
                folders.remove(spark, f"{path}/{INDEX}/{piece.name}")


# --- the index of keys ---


def _hash(seed: int) -> str:
    return f"xxhash64({seed}, record_id, ts)"


#: The bits of a key in its word.
MASK = " | ".join(f"shiftleft(1L, cast(shiftright({_hash(2)}, {6 * i}) & 63 as int))" for i in range(KEY_BITS))


def index_rows(rows: DataFrame) -> DataFrame:
    """The index of a piece: a row for each day, and the words of the day's filter, as many as a power of two."""
    days = rows.groupBy(DAY).agg(
        F.count("*").alias("n"), F.min("record_id").alias("low_id"), F.max("record_id").alias("high_id"),
        F.min("ts").alias("low_ts"), F.max("ts").alias("high_ts"),
    ).withColumn("words", F.expr(f"cast(shiftleft(1L, cast(ceil(log2(greatest(n / {KEYS_PER_WORD}, 1))) as int)) as bigint)"))
    keys = rows.select(DAY, F.expr(_hash(1)).alias("place"), F.expr(MASK).alias("mask"))
    words = (
        keys.join(days.select(DAY, "words"), DAY).groupBy(DAY, F.expr("pmod(place, words)").alias("word"))
        .agg(F.expr("bit_or(mask)").alias("bits"))
    )
    names = INDEX_ROWS.fieldNames()
    days = days.withColumns({"word": F.lit(-1).cast("bigint"), "bits": F.lit(0).cast("bigint")}).select(*names)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in INDEX_ROWS.fields if f.name not in words.columns}
    return days.unionByName(words.withColumns(missing).select(*names))


def write_index(spark: SparkSession, path: str, schema: T.StructType, piece: Piece) -> None:
    rows = read_pieces(spark, path, schema, [piece]).select(DAY, *KEY)
    # Sorted, so that words can be skipped by row groups; a large piece's filter has several files.
    index = index_rows(rows).hint("rebalance").sortWithinPartitions(DAY, "word")
    index.write.mode("overwrite").parquet(f"{path}/{INDEX}/{piece.name}")


def forget_index(spark: SparkSession, path: str, batch_id: int) -> None:
    folders.remove(spark, f"{path}/{INDEX}/{batch_id}_{batch_id}")


def read_index(spark: SparkSession, path: str, pieces: list[Piece]) -> tuple[DataFrame | None, list[Piece]]:
    """The index rows of the pieces that have one, with the piece's ``piece`` name, and the pieces that have none."""
    indexed = {mark.split("/")[-2] for mark in folders.matching(spark, f"{path}/{INDEX}/*/_SUCCESS")}
    found = [p for p in pieces if p.name in indexed]
    if not found:
        return None, pieces
    rows = spark.read.schema(INDEX_ROWS).parquet(*(f"{path}/{INDEX}/{p.name}" for p in found))
    rows = rows.withColumn("piece", F.element_at(F.split("_metadata.file_path", "/"), -2))
    return rows, [p for p in pieces if p.name not in indexed]


def latest_time(spark: SparkSession, path: str, pieces: list[Piece]) -> tuple[object, list[Piece]]:
    """The newest time of the indexed pieces in microseconds, and the pieces without index."""
    index, others = read_index(spark, path, pieces)
    if index is None:
        return None, others
    return index.where("word = -1").agg(F.expr("unix_micros(max(high_ts))")).first()[0], others


def known_keys(spark: SparkSession, path: str, schema: T.StructType, batch: DataFrame, days: list[int], but_batch: int) -> DataFrame | None:
    """The keys ``record_id, ts`` of ``batch`` that other batches have stored; ``None`` if there are none for sure.

    ``batch`` has ``ts_day`` and must be stored. First the ranges of ids leave out pieces, then the filters leave out
    keys; only pieces that a key passes the filter of have their keys read, and only for the days of such keys. Keys of
    pieces without index are read. A filter lets no stored key through unseen, so the result is exact.
    """
    live = [p for p in live_pieces(all_pieces(spark, path, days=days)) if (p.low, p.high) != (but_batch, but_batch)]
    if not live:
        return None
    index, unknown = read_index(spark, path, live)
    keys = batch.select(DAY, *KEY)
    suspects: list[tuple[str, int]] = []
    passed = None
    if index is not None:
        index = index.where(F.col(DAY).isin(days))
        ranges = index.where("word = -1").select(DAY, "piece", "words", "low_id", "high_id").withColumnRenamed(DAY, "of_day")
        # A row for each day and piece; Spark sends them to the tasks by its size check.
        placed = keys.join(ranges, (F.col(DAY) == F.col("of_day")) & (F.col("record_id") >= F.col("low_id")) & (F.col("record_id") <= F.col("high_id")))
        placed = placed.select(*KEY, DAY, "piece", F.expr(f"pmod({_hash(1)}, words)").alias("word"), F.expr(MASK).alias("mask"))
        words = index.where("word >= 0").select(DAY, "piece", "word", "bits")
        passed = placed.join(words, [DAY, "piece", "word"]).where("(bits & mask) = mask")
        # At most a row for each day and live piece.
        suspects = [(r[0], r[1]) for r in passed.select("piece", DAY).distinct().collect()]
    if not suspects and not unknown:
        return None
    names = {name for name, _ in suspects}
    frames = []
    if suspects:
        opened = [p for p in live if p.name in names]
        rows = read_pieces(spark, path, schema, opened).where(F.col(DAY).isin(sorted({day for _, day in suspects})))
        frames.append(rows.select(*KEY))
    if unknown:
        frames.append(read_pieces(spark, path, schema, unknown).where(F.col(DAY).isin(days)).select(*KEY))
    stored = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    return stored.join(keys.select(*KEY), KEY, "left_semi")
