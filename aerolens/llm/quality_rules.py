"""Quality rules: how far a document's characters and common words are from those of its language."""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from aerolens.llm.common import ASCII_SPACE, WORD, fold_ascii, prepared

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

CLASSES = [
    "lower", "upper", "other_letter", "digit", "blank", "line_end", "stop", "punctuation", "symbol", "other",
]
#: Distinct (language, word) counts that a task gathers before it hands them on.
WORDS_AT_ONCE = 200_000


@dataclass(frozen=True)
class Limits:
    """Largest Jensen-Shannon distances (0 to 1) and the lengths from which they are asked for."""

    char_distance: float = 0.28
    min_chars: int = 200
    word_distance: float = 0.55
    min_words: int = 50


@dataclass
class Reference:
    """A language's shares of the character classes, and of its common words and all others."""

    characters: np.ndarray
    index: dict[str, int]
    words: np.ndarray


def _class_of(character: str) -> str:
    kind = unicodedata.category(character)
    if character == "\n":
        return "line_end"
    if character in ASCII_SPACE or kind == "Zs":
        return "blank"
    if kind == "Nd":
        return "digit"
    if character in ".,;:!?":
        return "stop"
    if kind[0] == "L":
        return {"Ll": "lower", "Lu": "upper"}.get(kind, "other_letter")
    return {"P": "symbol" if character in SYMBOLS else "punctuation", "S": "symbol"}.get(kind[0], "other")


@cache
def _classes() -> np.ndarray:
    """Class of each code point below 65536; those above are ``other``."""
    return np.array([CLASSES.index(_class_of(chr(point))) for point in range(1 << 16)], dtype=np.uint8)


def characters(text: str) -> np.ndarray:
    """How many characters of each class a text has."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    table = _classes()
    inside = points < len(table)
    found = np.bincount(table[points[inside]], minlength=len(CLASSES))
    found[CLASSES.index("other")] += len(points) - np.count_nonzero(inside)
    return found


def distance(left: np.ndarray, right: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms, 0 to 1; 1 if one of them is empty."""
    if not left.sum() or not right.sum():
        return 1.0
    p, q = left / left.sum(), right / right.sum()
    middle = (p + q) / 2

    def part(x):
        some = x > 0
        return float((x[some] * np.log2(x[some] / middle[some])).sum())

    return float(np.sqrt(max(0.0, (part(p) + part(q)) / 2)))


def base_counts(text: str, words: list[str]) -> tuple[int, int, int, int]:
    """``word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text and its words."""
    seen: set[str] = set()
    repeated_lines = 0
    for line in text.split("\n"):
        if line.strip(ASCII_SPACE):
            repeated_lines += line in seen
            seen.add(line)
    repeated_words = 0
    if len(words) > 3:
        ids = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
        windows = (ids[:-2] * np.uint64(0x9E3779B97F4A7C15) + ids[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + ids[2:]
        _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
        twice = times[which] > 1
        inside = np.zeros(len(words), dtype=bool)
        for i in range(3):
            inside[i : i + len(twice)] |= twice
        repeated_words = int(inside.sum())
    return sum(map(len, words)), sum(map(text.count, SYMBOLS)), repeated_lines, repeated_words


def references(
    docs: DataFrame, *, text_column: str = "text", lang_column: str = "lang", common_words: int = 150
) -> dict[str, Reference]:
    """Histograms of every language over all its documents; rows without language or text are left out.

    Words are counted in the tasks and summed up by Spark; the class totals and the ``common_words`` of each
    language come to the driver, whose number is bounded by that of the languages.
    """
    prepared(docs.sparkSession)
    rows = docs.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text")).where(
        "lang is not null and text is not null"
    )

    def count(arrived):
        classes: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def out():
            found = [(lang, "w", word, n) for lang, counter in words.items() for word, n in counter.items()]
            found += [(lang, "c", CLASSES[i], int(n)) for lang, many in classes.items() for i, n in enumerate(many)]
            words.clear()
            classes.clear()
            columns = list(zip(*found)) or [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64()))],
                ["lang", "kind", "name", "n"],
            )

        for batch in arrived:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                classes[lang] = classes.get(lang, 0) + characters(text)
                words.setdefault(lang, Counter()).update(WORD.findall(fold_ascii(text)))
            if sum(map(len, words.values())) >= WORDS_AT_ONCE:
                yield out()
        yield out()

    counted = (
        rows.mapInArrow(count, "lang string, kind string, name string, n bigint")
        .groupBy("lang", "kind", "name").agg(F.sum("n").alias("n"))
    )
    first = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "name"))
    top = counted.withColumn("place", first).where(F.col("place") <= common_words).drop("place")
    sizes = counted.groupBy("lang").agg(F.sum(F.when(F.col("kind") == "w", F.col("n"))).alias("n")).selectExpr(
        "lang", "'t' as kind", "'' as name", "coalesce(n, 0L) as n"
    )
    found: dict[str, dict[str, dict[str, int]]] = {}
    for row in top.unionByName(sizes).collect():
        found.setdefault(row["lang"], {"w": {}, "c": {}, "t": {}})[row["kind"]][row["name"]] = row["n"]
    made = {}
    for lang, parts in found.items():
        words = sorted(parts["w"])
        common = [parts["w"][word] for word in words]
        rest = parts["t"].get("", 0) - sum(common)
        made[lang] = Reference(
            np.array([parts["c"].get(name, 0) for name in CLASSES]), {w: i for i, w in enumerate(words)},
            np.array([*common, rest]),
        )
    return made


def quality_rules(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    limits: Limits = Limits(),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Base counts and the verdict of each document; one row per input row.

    Returns the id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``char_distance``, ``word_distance``, ``kept`` and the ``carry`` columns. A document is kept
    if it passes the base rules, its characters are within ``limits.char_distance`` of its language's and its
    words within ``limits.word_distance``. A distance is null, and not asked for, below the minimum length or if
    there is nothing to compare with. Without a language of its own a document takes the nearest one.

    A null text has no words, so it fails the base rules. Whole texts are read twice, without shuffling them.
    """
    made = references(docs, text_column=text_column, lang_column=lang_column)
    shared = docs.sparkSession.sparkContext.broadcast(made)
    given = docs.select(
        F.col(id_column).alias("_id"), F.col(lang_column).alias("_lang"), F.col(text_column).alias("_text"),
        *(F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)),
    )
    added = (
        "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, char_distance double, word_distance double, kept boolean"
    )
    names = [part.split()[0] for part in added.split(", ")]
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    types = [kinds[part.split()[1]] for part in added.split(", ")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema if f.name != "_text")

    def judge(arrived):
        known = shared.value
        for batch in arrived:
            out = []
            for lang, value in zip(batch.column(1).to_pylist(), batch.column(2)):
                text = value.as_py() or ""
                words = WORD.findall(text)
                counts = base_counts(text, words)
                failed = len(words) < MIN_WORDS or 100 * counts[3] > MAX_REPEAT_PERCENT * len(words)
                far_chars = far_words = None
                near = [known[lang]] if lang in known else list(known.values())
                if near and counts[0] >= limits.min_chars:
                    own = characters(text)
                    far_chars = min(distance(own, r.characters) for r in near)
                if near and len(words) >= limits.min_words:
                    folded = WORD.findall(fold_ascii(text))
                    far_words = min(
                        distance(
                            np.bincount([r.index.get(w, len(r.index)) for w in folded], minlength=len(r.words)), r.words
                        )
                        for r in near
                    )
                kept = (
                    not failed
                    and (far_chars is None or far_chars <= limits.char_distance)
                    and (far_words is None or far_words <= limits.word_distance)
                )
                out.append((len(words), *counts, failed, far_chars, far_words, kept))
            columns = [c for c, n in zip(batch.columns, batch.schema.names) if n != "_text"]
            rest = [n for n in batch.schema.names if n != "_text"]
            found = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(v, t) for v, t in zip(found, types))], [*rest, *names]
            )

    return given.mapInArrow(judge, f"{schema}, {added}").select(
        F.col("_id").alias(id_column), *names, *(F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry))
    )
