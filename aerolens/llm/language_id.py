"""Language ID with bit-sliced Bloom filters: each position holds a mask of languages."""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from aerolens.llm.common import prepared

UNKNOWN = "und"
ORDERS = (3, 4)
HASHES = 3
#: Odd 64-bit factors for the characters of an n-gram, counted from its end.
FACTORS = np.array(
    [pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(max(ORDERS))], dtype=np.uint64
)
#: Characters of a text that are looked at together.
BLOCK = 1 << 20


@dataclass
class Model:
    """Languages, their filters (``masks[position, word]``), and the share of positions each has set."""

    languages: list[str]
    masks: np.ndarray
    filled: np.ndarray


@cache
def _characters() -> np.ndarray:
    """The lower-case letter of each code point, and a blank for all that is no letter."""
    table = np.full(sys.maxunicode + 1, 32, dtype=np.uint32)
    for point in range(sys.maxunicode + 1):
        character = chr(point)
        if character.isalpha():
            lower = character.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


def grams(text: str):
    """Blocks of hashes of a text's n-grams; runs of what is no letter are one blank, also at both ends."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    tail = np.array([32], dtype=np.uint32)
    for begin in range(0, len(points), BLOCK):
        block = np.concatenate([tail, _characters()[points[begin : begin + BLOCK]]])
        if begin + BLOCK >= len(points):
            block = np.append(block, np.uint32(32))
        blank = block == 32
        block = block[~(blank & np.append(False, blank[:-1]))].astype(np.uint64)
        for n in ORDERS:
            # N-grams of an earlier block are left out: only those that end after the tail are new.
            first = max(0, len(tail) - n + 1) if begin else 0
            if len(block) - n + 1 > first:
                size = len(block) - n + 1 - first
                mixed = np.full(size, n, dtype=np.uint64)
                for i in range(n):
                    mixed += block[first + i : first + i + size] * FACTORS[n - 1 - i]
                mixed ^= mixed >> np.uint64(29)
                mixed *= np.uint64(0xBF58476D1CE4E5B9)
                mixed ^= mixed >> np.uint64(32)
                yield mixed
        tail = block[-(max(ORDERS) - 1) :].astype(np.uint32)


def _positions(hashes: np.ndarray, size: int):
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for i in range(HASHES):
        yield ((hashes + np.uint64(i) * step) & np.uint64(size - 1)).astype(np.int64)


def build(languages: list[str], pairs: list[tuple[int, np.ndarray]]) -> Model:
    """Filters from the n-gram hashes of each language; there are at least 12 positions per n-gram."""
    distinct = sum(len(hashes) for _, hashes in pairs)
    size = 1 << max(10, int(12 * distinct).bit_length())
    words = -(-max(1, len(languages)) // 64)
    kind = np.uint8 if len(languages) <= 8 else np.uint64
    masks = np.zeros((size, words), dtype=kind)
    for language, hashes in pairs:
        bit = kind(1) << kind(language % 64)
        for at in _positions(hashes, size):
            np.bitwise_or.at(masks[:, language // 64], at, bit)
    filled = np.array(
        [((masks[:, i // 64] >> kind(i % 64)) & kind(1)).mean() for i in range(len(languages))]
    )
    return Model(languages, masks, filled)


def shares(text: str, model: Model) -> tuple[np.ndarray | None, int]:
    """The share of a text's n-grams each language knows, without the false positives to be expected, and their number.

    ``None`` and 0 if the text has no letter.
    """
    total, hits = 0, np.zeros(len(model.languages))
    size, kind = len(model.masks), model.masks.dtype.type
    for hashes in grams(text):
        found = None
        for at in _positions(hashes, size):
            found = model.masks[at] if found is None else found & model.masks[at]
        total += len(hashes)
        for i in range(len(hits)):
            hits[i] += np.count_nonzero(found[:, i // 64] & (kind(1) << kind(i % 64)))
    if not total:
        return None, 0
    wrong = model.filled**HASHES
    return np.clip((hits / total - wrong) / (1 - wrong), 0.0, 1.0), total


def fit(
    labelled: DataFrame,
    *,
    text_column: str = "text",
    lang_column: str = "lang",
    sample_docs: int = 1500,
    min_share: float = 2e-5,
    rarer: float = 0.05,
) -> Model:
    """Learn from labelled texts; rows without text or language teach nothing.

    About ``sample_docs`` documents of each language are taken by the hash of their text, so the work does not
    grow with the corpus. A language's filter gets the n-grams that make up at least ``min_share`` of its
    n-grams, which are at most ``1 / min_share``, and ``rarer`` of the largest share any language has.
    So the filters' size is bounded by the number of languages, and only what enters them comes to
    the driver. The languages are ordered by their number of documents, then by name.
    """
    prepared(labelled.sparkSession)
    rows = labelled.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text")).where(
        "lang is not null and text is not null"
    )
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    languages = [row["lang"] for row in sizes]
    if not languages:
        return build([], [])
    rate = F.lit(1.0)
    for row in sizes:
        rate = F.when(F.col("lang") == row["lang"], F.lit(sample_docs / row["count"])).otherwise(rate)
    draw = F.pmod(F.xxhash64(F.lit("sample"), "text"), F.lit(1 << 20)) / float(1 << 20)

    def count(arrived):
        for batch in arrived:
            by_language: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_language.setdefault(lang, []).extend(grams(text))
            for lang, parts in by_language.items():
                found, times = np.unique(np.concatenate(parts or [np.zeros(0, np.uint64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(times)],
                    ["lang", "gram", "n"],
                )

    counted = (
        rows.where(draw < rate).mapInArrow(count, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    share = counted.join(totals, "lang").withColumn("share", F.col("n") / F.col("total"))
    known = (
        share.withColumn("most", F.max("share").over(Window.partitionBy("gram")))
        .where((F.col("share") >= min_share) & (F.col("share") >= rarer * F.col("most")))
        .select("lang", "gram").toPandas()
    )
    pairs = [
        (i, known.loc[known["lang"] == lang, "gram"].to_numpy(np.int64).view(np.uint64))
        for i, lang in enumerate(languages)
    ]
    return build(languages, pairs)


def predict(
    docs: DataFrame, model: Model, *, id_column: str = "doc_id", text_column: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """The language whose filter knows most n-grams of each text; one row per input row.

    Returns the id, ``lang_pred``, ``score`` (the share known, 0 to 1), ``n_grams`` (how many were looked up) and the
    ``carry`` columns. A text that is null or has no letter is ``und`` with score 0, as is every text if nothing was learned. Of equal
    shares the language learned from more documents wins. Whole texts are read, nothing is shuffled.
    """
    prepared(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # The text goes to Python once, and comes back only if it is carried.
    others = [c for c in carry if c != text_column]
    given = docs.select(
        F.col(text_column).alias("_text"), F.col(id_column).alias("_id"),
        *(F.col(c).alias(f"_carry_{i}") for i, c in enumerate(others)),
    )
    back = given if text_column in carry else given.drop("_text")
    schema = back.select("*", F.lit("").alias("_lang"), F.lit(0.0).alias("_score"), F.lit(0).cast("bigint").alias("_grams")).schema
    skipped = 0 if text_column in carry else 1

    def judge(arrived):
        model = shared.value
        for batch in arrived:
            langs, scores, sizes = [], [], []
            for text in batch.column(0):
                known, size = shares(text.as_py() or "", model) if model.languages else (None, 0)
                lang, score = UNKNOWN, 0.0
                if known is not None:
                    best = int(known.argmax())
                    lang, score = model.languages[best], float(known[best])
                langs.append(lang)
                scores.append(score)
                sizes.append(size)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[skipped:], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(sizes, pa.int64())],
                [*batch.schema.names[skipped:], "_lang", "_score", "_grams"],
            )

    names = {c: f"_carry_{i}" for i, c in enumerate(others)} | {text_column: "_text"}
    return given.mapInArrow(judge, schema).select(
        F.col("_id").alias(id_column), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"),
        F.col("_grams").alias("n_grams"),
        *(F.col(names[c]).alias(c) for c in carry),
    )


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a document belongs to the quarter that nothing is learned from; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_id(docs: DataFrame, **names) -> DataFrame:
    """Learn from the labelled documents that are not held out, and predict all of them."""
    id_column = names.get("id_column", "doc_id")
    lang = names.pop("lang_column", "lang")
    learned_from = docs.where(F.col(id_column).isNotNull() & ~held_out(id_column))
    text_column = names.get("text_column", "text")
    model = fit(learned_from, text_column=text_column, lang_column=lang)
    return predict(docs, model, **names)
