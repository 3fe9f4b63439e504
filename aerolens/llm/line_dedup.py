"""Line dedup: explode normalised lines, hash them, count documents per hash, drop, reassemble by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from aerolens.llm.common import ASCII_SPACE, id_key, lower_ascii, prepared
from aerolens.session import materialized


def line_dedup(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = 10,
    min_docs: int = 2,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Drop lines whose key is found in ``min_docs`` documents or more, but not from the smallest id holding it.

    A text is split at line feeds. The key of a line is the line without ASCII white space at its ends and
    with A-Z lower-cased; keys of under ``min_chars`` code points are left alone. Returns one row per input
    row: the id, ``text`` (the kept lines), ``n_lines`` before dropping, ``n_dropped`` and the ``carry`` columns.

    Only keys' 128-bit hashes are shuffled to be counted: a line of every document is one row per task
    there. The texts are shuffled once, to meet the positions they lose.

    A null or empty text is one empty line. Rows with the same id are one document for the count, and
    each is returned; a null id is one id above all others. An empty table gives an empty result.
    """
    prepared(docs.sparkSession)
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        id_key(id_column).alias("_id"), F.xxhash64(text).alias("_row"), text.alias("_text"),
        F.col(id_column).alias("_given"), *(F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)),
    )
    lines = rows.select("_id", "_row", F.posexplode(F.split("_text", "\n")).alias("_pos", "_line"))
    key = lower_ascii(F.btrim("_line", F.lit(ASCII_SPACE)))
    hashed = materialized(
        lines.select("_id", "_row", "_pos", key.alias("_key"))
        .where(F.char_length("_key") >= min_chars)
        .select("_id", "_row", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2")),
        "line-keys",
    )
    # Stored, so that both sides of the join below are plain shuffles, whose skew Spark splits.
    repeated = materialized(
        hashed.groupBy("_h1", "_h2")
        .agg(F.countDistinct("_id").alias("_docs"), F.min("_id").alias("_first"))
        .where(F.col("_docs") >= min_docs)
        .select("_h1", "_h2", "_first"),
        "repeated-lines",
    )
    lost = (
        hashed.join(repeated, ["_h1", "_h2"])
        .where("_id <> _first")
        .select("_id", "_row", "_pos")
        .distinct()  # rows given twice lose a line once
        .groupBy("_id", "_row")
        .agg(F.collect_list("_pos").alias("_lost"))
    )
    # Split below the join: above it, the lambda would split the text again for each line.
    whole = rows.select("*", F.split("_text", "\n").alias("_lines")).drop("_text")
    kept = F.when(F.col("_lost").isNull(), F.col("_lines")).otherwise(
        F.transform(
            F.array_except(F.expr("sequence(0, size(_lines) - 1)"), "_lost"), lambda i: F.get("_lines", i)
        )
    )
    return whole.join(lost.hint("shuffle_hash"), ["_id", "_row"], "left").select(
        F.col("_given").alias(id_column),
        F.array_join(kept, "\n").alias("text"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_lost"), F.lit(0)).cast("bigint").alias("n_dropped"),
        *(F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry)),
    )
