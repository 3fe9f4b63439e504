"""Packing: length buckets that waste least padding, and batches of a token budget inside each."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from aerolens.llm.common import id_key, prepared, ranked
from aerolens.llm.mixing import word_count
from aerolens.session import materialized

#: Lengths of more bits than this are rounded up to so many leading bits before they may be a bucket's bound.
BITS = 8


def bounds(lengths: np.ndarray, counts: np.ndarray, tokens: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding, by dynamic programming.

    ``lengths`` are the possible bounds in rising order, with the number of documents at each and their tokens.
    Of equal choices the one with the smallest split wins.
    """
    size = len(lengths)
    if not size:
        return []
    many = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    inside = np.concatenate([[0], np.cumsum(tokens, dtype=np.int64)])
    huge = np.iinfo(np.int64).max // 4
    best = np.full(size + 1, huge, dtype=np.int64)
    best[0] = 0
    splits = []
    for _ in range(buckets):
        step, split = np.full(size + 1, huge, dtype=np.int64), np.zeros(size + 1, dtype=np.int64)
        step[0] = 0
        for j in range(1, size + 1):
            waste = best[:j] + lengths[j - 1] * (many[j] - many[:j]) - (inside[j] - inside[:j])
            split[j] = int(np.argmin(waste))
            step[j] = waste[split[j]]
        splits.append(split)
        best = step
    found, j = [], size
    for split in reversed(splits):
        if not j:
            break
        found.append(int(lengths[j - 1]))
        j = int(split[j])
    return found[::-1]


def pack(
    docs: DataFrame,
    *,
    buckets: int = 8,
    budget: int = 16_384,
    seed: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokens: Callable[[Column], Column] = word_count,
) -> DataFrame:
    """Bucket, batch and slot of every document. ``tokens`` gives the tokens of a text column, as in ``mix``.

    The histogram of all lengths is global. Bounds are lengths rounded up to ``BITS`` leading bits, so the driver
    gets at most 128 rows per doubling of the length however many documents there are. All documents of
    a bucket are padded to ``bucket_tokens``, its bound, and ``max(1, budget // bucket_tokens)`` of them, in an order
    drawn from the seed, are one batch. Returns one row per input row: the id, ``n_tokens``, ``bucket`` (from 1),
    ``bucket_tokens``, ``batch`` (from 0 in each bucket) and ``slot`` (from 0 in each batch).

    Null and empty texts have no tokens. Rows of equal ids are ordered by tokens, then by the hash of their text;
    a null id is one id. A document above the budget is a batch of its own. Running numbers are
    added up by ranges of the order, so a bucket with a third of all rows is spread over tasks.
    """
    prepared(docs.sparkSession)
    text = F.col(text_column)
    rows = materialized(
        docs.select(
            id_key(id_column).alias("_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_row"),
            tokens(text).alias("n_tokens"),
        ), "pack-rows",
    )
    step = f"shiftleft(1L, cast(greatest(0, length(bin(n_tokens)) - {BITS}) as int))"
    rounded = F.expr(f"((n_tokens + {step} - 1) div {step}) * {step}")
    shape = (
        rows.groupBy(rounded.alias("bound")).agg(F.count("*").alias("n"), F.sum("n_tokens").alias("tokens"))
        .orderBy("bound").toPandas()
    )
    limits = bounds(*(shape[c].to_numpy(np.int64) for c in ("bound", "n", "tokens")), buckets)
    # At most ``buckets`` numbers; without rows any will do.
    upper = F.array(*(F.lit(limit).cast("bigint") for limit in limits or [0]))
    below = F.size(F.filter(upper, lambda limit: limit < F.col("_bound")))
    placed = rows.withColumn("_bound", rounded).withColumn("_below", below).withColumns({
        "bucket": (F.col("_below") + 1).cast("bigint"), "bucket_tokens": F.get(upper, F.col("_below")),
    }).withColumn("_size", F.expr(f"greatest(1L, {budget}L div greatest(1L, bucket_tokens))"))
    drawn = placed.withColumn(
        "_draw", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_id").cast("string")))
    ).withColumn("_one", F.lit(1).cast("bigint"))
    numbered = ranked(drawn, ["bucket"], "_draw", ["n_tokens", "_row"], {"_index": "_one"})
    return numbered.select(
        F.when(F.col("_id") != 2**63 - 1, F.col("_id")).alias(id_column), "n_tokens", "bucket", "bucket_tokens",
        F.expr("_index div _size").alias("batch"), F.expr("_index % _size").alias("slot"),
    )
