"""Mixing sources to target weights: budgets flow down a tree, leaves are filled from seeded epochs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from aerolens.llm.common import id_key, prepared, ranked
from aerolens.session import materialized

#: What counts as a word, for Spark's regular expressions.
WORDS = r"[^\x20\x09-\x0D]+"
WIDE = "decimal(38,0)"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    """Whole-number weight of a node; those that are not named weigh 1."""
    found = F.lit(1)
    for name, weight in weights.items():
        found = F.when(F.col(level).eqNullSafe(F.lit(name)), F.lit(weight)).otherwise(found)
    return found.cast(WIDE)


def budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], budget: int, epochs: int
) -> DataFrame:
    """``levels, supply, budget``: what each leaf is to give of ``budget`` tokens.

    A node shares its budget among its children by their weights. A child that cannot take its share, as its leaves
    have no more than ``epochs`` times their tokens, takes all it can, and its siblings share the rest by
    their weights. Only what all of them cannot take is missing at the parent, where it goes to the parent's
    siblings. So every node's budget is settled by one pass over its children, least capacity for its weight
    first. Whole tokens left over by division go to the first children that have room, by name.
    """
    leaves = leaves.withColumn("_capacity", (F.col("supply") * epochs).cast(WIDE))
    top = leaves.agg(F.least(F.lit(budget).cast(WIDE), F.coalesce(F.sum("_capacity"), F.lit(0)).cast(WIDE)).alias("_given"))
    given: DataFrame | None = None
    for depth in range(1, len(levels) + 1):
        parent, path = list(levels[: depth - 1]), list(levels[:depth])
        nodes = leaves.groupBy(*path).agg(F.sum("_capacity").cast(WIDE).alias("_capacity"))
        if given is None:
            nodes = nodes.withColumn("_given", top.scalar())
        else:
            above = given.select(*(F.col(c).alias(f"_up_{c}") for c in parent), F.col("_budget").alias("_given"))
            nodes = nodes.join(above, [F.col(c).eqNullSafe(F.col(f"_up_{c}")) for c in parent]).drop(
                *(f"_up_{c}" for c in parent)
            )
        nodes = nodes.withColumn("_weight", _weight(levels[depth - 1], weights.get(levels[depth - 1], {})))
        order = [F.col("_capacity").cast("double") / F.col("_weight").cast("double"), F.col(levels[depth - 1])]
        siblings = Window.partitionBy(*parent)
        so_far = siblings.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        still = siblings.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
        nodes = nodes.withColumn("_full_before", F.coalesce(F.sum("_capacity").over(so_far), F.lit(0)).cast(WIDE))
        nodes = nodes.withColumn("_weight_left", F.sum("_weight").over(still).cast(WIDE))
        room = F.col("_capacity") * F.col("_weight_left") > F.col("_weight") * (F.col("_given") - F.col("_full_before"))
        nodes = nodes.withColumn("_room", room.cast("int"))
        upto = siblings.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        nodes = nodes.withColumn("_open", F.max("_room").over(upto))
        closed = F.sum(F.when(F.col("_open") == 0, F.col("_capacity")).otherwise(F.lit(0).cast(WIDE))).over(siblings)
        weight = F.sum(F.when(F.col("_open") == 1, F.col("_weight")).otherwise(F.lit(0).cast(WIDE))).over(siblings)
        nodes = nodes.withColumn("_rest", (F.col("_given") - closed).cast(WIDE)).withColumn("_shared", weight.cast(WIDE))
        share = F.expr("case when _open = 1 then (_weight * _rest) div _shared else cast(_capacity as bigint) end")
        nodes = nodes.withColumn("_share", share.cast("bigint"))
        left = F.col("_given") - F.sum("_share").over(siblings)
        place = F.row_number().over(Window.partitionBy(*parent, "_open").orderBy(levels[depth - 1]))
        more = ((F.col("_open") == 1) & (place <= left)).cast("bigint")
        given = nodes.withColumn("_left", left).select(*path, (F.col("_share") + more).alias("_budget"))
    assert given is not None
    final = given.select(*(F.col(c).alias(f"_up_{c}") for c in levels), F.col("_budget").alias("budget"))
    return leaves.drop("_capacity").join(
        final, [F.col(c).eqNullSafe(F.col(f"_up_{c}")) for c in levels]
    ).select(*levels, "supply", "budget")


def mix(
    docs: DataFrame,
    *,
    levels: Mapping[str, str],
    weights: Mapping[str, Mapping[str, int]] | None = None,
    percent: int = 50,
    epochs: int = 2,
    seed: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokens: Callable[[Column], Column] = word_count,
) -> DataFrame:
    """How often each document enters a mixture of ``percent`` of all tokens with the given weights.

    ``levels`` names the tree's levels from the top, each a SQL expression over the documents. ``tokens`` gives the
    tokens of a text column: ``token_counts.token_count`` those of a tokenizer, ``word_count`` words.
    A leaf is taken whole as often as its budget allows, at most ``epochs`` times. For the rest its documents are
    put in an order drawn from the seed and the epoch, and those are taken whose running total fits.
    Returns one row per input row: the id, ``row`` (the hash of its text), the levels, ``n_tokens``,
    ``budget`` of its leaf and ``copies``, 0 if it is not taken.

    Null levels are values of their own, named before all others; null and empty texts have no tokens and come with
    the first of their leaf. Rows of equal ids are ordered by tokens, then by the hash of their text. Running
    totals are added up by ranges of the order, so a leaf with a third of all rows is spread over tasks. Texts are
    read once and not shuffled.
    """
    prepared(docs.sparkSession)
    names = list(levels)
    text = F.col(text_column)
    rows = materialized(
        docs.select(
            id_key(id_column).alias("_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_row"),
            *(F.expr(sql).alias(name) for name, sql in levels.items()), tokens(text).alias("n_tokens"),
        ), "mix-rows",
    )
    leaves = materialized(rows.groupBy(*names).agg(F.sum("n_tokens").alias("supply")), "leaves")
    total = leaves.agg(F.sum("supply")).first()[0] or 0
    given = materialized(budgets(leaves, names, weights or {}, int(total) * percent // 100, epochs), "budgets")
    given = given.withColumn("_full", F.expr("coalesce(budget div nullif(supply, 0), 0L)")).withColumn(
        "_rest", F.col("budget") - F.col("_full") * F.col("supply")
    )
    up = given.select(*(F.col(c).alias(f"_up_{c}") for c in names), "budget", "_full", "_rest")
    joined = rows.join(up, [F.col(c).eqNullSafe(F.col(f"_up_{c}")) for c in names]).drop(*(f"_up_{c}" for c in names))
    drawn = joined.withColumn(
        "_draw", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_full").cast("string"), F.col("_id").cast("string")))
    )
    totals = ranked(drawn, names, "_draw", ["n_tokens", "_row"], {"_before": "n_tokens"})
    taken = (F.col("_before") + F.col("n_tokens") <= F.col("_rest")).cast("bigint")
    return totals.select(
        F.when(F.col("_id") != 2**63 - 1, F.col("_id")).alias(id_column), F.col("_row").alias("row"), *names, "n_tokens",
        "budget", (F.col("_full") + taken).alias("copies"),
    )
