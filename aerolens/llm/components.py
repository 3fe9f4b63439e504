"""Links inside groups of candidates without all their pairs, and connected components of links."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from aerolens.session import lasting, materialized, scratch_removed


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of all nodes of the links ``a, b``: the component is its smallest node.

    Each round takes the least label among a node's neighbours, then the label of that label, so the rounds
    grow with the logarithm of a path's length. Every round is stored, so lost executors cost one round.
    Links may repeat, and may lead from a node to itself. Without links the result is empty.
    """
    with scratch_removed(links.sparkSession):
        both = materialized(
            links.select("a", "b").union(links.select("b", "a")).distinct().toDF("node", "other"), "links"
        )
        labels = materialized(
            both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("component")), "labels"
        )
        while True:
            near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(
                F.min("component").alias("near")
            )
            least = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("near"))
            jump = labels.select(F.col("node").alias("near"), F.col("component").alias("far"))
            step = materialized(
                least.join(jump, "near").select("node", F.least("near", "far").alias("to"), F.col("component").alias("was")),
                "labels",
            )
            labels = step.select("node", F.col("to").alias("component"))
            if not step.where(F.col("to") != F.col("was")).limit(1).count():
                lasting(step)
                return labels


def ordered_pair(left: str, right: str) -> list[Column]:
    x, y = F.col(f"{left}.id"), F.col(f"{right}.id")
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


#: Most sets, and about how many tokens, that one task compares with as many others.
BLOCK_SETS = 1024
BLOCK_TOKENS = 1 << 21
#: Given a group's rows: which of the later rows ``near`` may be linked with row ``i``.
Fits = Callable[[pa.Table], Callable[[int, np.ndarray], np.ndarray]]


def in_blocks(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deal the rows of each group to pairs of blocks, ``x, y``, each small enough for a task.

    A group of few rows is one block. A larger one has blocks by a hash of the id; a row goes to all pairs of its block.
    """
    parts = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int")
    sizes = rows.groupBy(*keys).agg(parts.alias("parts"))
    spread = rows.join(sizes, list(keys)).withColumn("block", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = spread.withColumn("other", other).select(
        *rows.columns, "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")
    )
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(count, *keys, "x", "y").sortWithinPartitions(*keys, "x", "y", "id")


def block_groups(arrived: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The rows of each pair of blocks, which come one after the other but over the ends of batches."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in arrived:
        if not batch.num_rows:
            continue
        places = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (*keys, "x", "y")], axis=1)
        cuts = [0, *(np.flatnonzero((places[1:] != places[:-1]).any(axis=1)) + 1).tolist(), len(places)]
        for begin, end in zip(cuts, cuts[1:]):
            if held and tuple(places[begin]) != current:
                yield pa.Table.from_batches(held)
                held = []
            current = tuple(places[begin])
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


def block_candidates(group: pa.Table, percent: int, fits: Fits) -> Iterator[tuple[int, np.ndarray]]:
    """For each row the later rows it may be linked to: of another component, similar size, and as ``fits`` says."""
    component, size, block = (group[c].to_numpy() for c in ("component", "n", "block"))
    one_block = group["x"][0].as_py() == group["y"][0].as_py()
    if (component == component[0]).all() or (not one_block and (block == block[0]).all()):
        return
    fitting = fits(group)
    for i in range(len(component) - 1):
        rest = slice(i + 1, None)
        found = component[rest] != component[i]
        if not one_block:
            found &= block[rest] != block[i]
        found &= 100 * np.minimum(size[rest], size[i]) >= percent * np.maximum(size[rest], size[i])
        near = np.flatnonzero(found) + i + 1
        if len(near):
            near = fitting(i, near)
            if len(near):
                yield i, near


def with_partner(rows: DataFrame, keys: Sequence[str], percent: int, fits: Fits) -> DataFrame:
    """The ``keys`` and ``id`` of rows that have a possible partner of another component in their group."""
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in (*keys, "id"))

    def work(arrived):
        for group in block_groups(arrived, keys):
            marked = np.zeros(group.num_rows, dtype=bool)
            for i, near in block_candidates(group, percent, fits):
                marked[i] = True
                marked[near] = True
            if marked.any():
                yield from group.select([*keys, "id"]).filter(pa.array(marked)).combine_chunks().to_batches()

    return in_blocks(rows, keys).mapInArrow(work, schema).distinct()


def candidate_pairs(rows: DataFrame, keys: Sequence[str], percent: int, fits: Fits) -> DataFrame:
    """Pairs ``a, b`` that connect, inside each group, all rows that may be linked; fewer than the group has rows."""

    def work(arrived):
        for group in block_groups(arrived, keys):
            ids, parent = group["id"].to_numpy(), list(range(group.num_rows))

            def root(i):
                while parent[i] != i:
                    parent[i] = parent[parent[i]]
                    i = parent[i]
                return i

            found = []
            for i, near in block_candidates(group, percent, fits):
                for j in near.tolist():
                    left, right = root(i), root(j)
                    if left != right:
                        parent[max(left, right)] = min(left, right)
                        found.append((ids[i], ids[j]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    return in_blocks(rows, keys).mapInArrow(work, "a bigint, b bigint").distinct()


def block_links(rows: DataFrame, keys: Sequence[str], percent: int, fits: Fits) -> DataFrame:
    """Links ``a, b`` that join the components of each group as all its links do, checked on the full sets ``tokens``.

    A pair that earlier links of the task joined already is not checked, so a task hands on fewer links than it has rows.
    """

    def work(arrived):
        for group in block_groups(arrived, keys):
            ids, component = group["id"].to_numpy(), group["component"].to_pylist()
            tokens: dict[int, np.ndarray] = {}
            parent: dict[int, int] = {}

            def root(label):
                while parent.get(label, label) != label:
                    parent[label] = parent.get(parent[label], parent[label])
                    label = parent[label]
                return label

            def of(i):
                if i not in tokens:
                    tokens[i] = np.asarray(group["tokens"][i].values)
                return tokens[i]

            found = []
            for i, near in block_candidates(group, percent, fits):
                for j in near.tolist():
                    left, right = root(component[i]), root(component[j])
                    if left == right:
                        continue
                    x, y = of(i), of(j)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        parent[max(left, right)] = min(left, right)
                        found.append((ids[i], ids[j]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    return in_blocks(rows, keys).mapInArrow(work, "a bigint, b bigint")


def links_in_groups(
    members: DataFrame,
    keys: Sequence[str],
    centre: Sequence[str],
    possible: Callable[[str, str], Column],
    fits: Fits,
    fits_anywhere: Fits,
    sets: Callable[[DataFrame], DataFrame],
    percent: int,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """Links ``a, b`` that give the same components as all links between members of one group.

    ``members`` has the ``keys`` of a group, a member's ``id`` and the size ``n`` of its set; ``possible`` says by the columns of
    two aliased members whether they may be linked, ``fits`` the same by the rows of a group, ``fits_anywhere`` by what does
    not depend on the group, and ``sets`` gives the full sets (``id, tokens``) of some ids. ``sketches`` are further columns for ``fits``, by ``id`` and ``n``. First each member is compared with its group's centre, the least by the ``centre``
    columns: one row per member, which joins groups of near copies. Only groups whose members are then still in
    several components go on. They are compared in blocks inside the tasks, which hand on pairs that connect all members
    that may be linked, fewer than there are members. What such pairs connect is a cluster, in which each member is once,
    with its set; clusters are compared in blocks too. ``members`` must be stored, as it is read several times. The links
    are stored too; what was stored on the way to them is removed as soon as nothing reads it any more.
    """
    spark, keys = members.sparkSession, list(keys)
    others = [c for c in members.columns if c not in (*centre, "id")]
    more = [] if sketches is None else [c for c in sketches.columns if c not in ("id", "n")]
    with scratch_removed(spark):
        with scratch_removed(spark):
            centres = lasting(materialized(
                members.groupBy(*keys).agg(F.min(F.struct(*centre, "id", *others)).alias("c"), F.count("*").alias("size"))
                .where("size > 1").select(*keys, "c"), "centres",
            ))
            near = members.alias("m").join(centres, keys).select(F.struct("m.*").alias("m"), "c")
            star = near.where((F.col("m.id") != F.col("c.id")) & possible("m", "c")).select(*ordered_pair("m", "c"))
            star = materialized(star.distinct(), "star")
            full = stored_sets(star.selectExpr("explode(array(a, b)) as id"), sets)
            links = lasting(materialized(verified_by_sets(star, full, percent), "links"))

        joined = materialized(components(links).withColumnRenamed("node", "id"), "joined")
        held = members.join(centres.select(*keys), keys, "left_semi").join(joined, "id", "left")
        held = held.withColumn("component", F.coalesce("component", "id"))
        still = held.groupBy(*keys).agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")
        ).where("low <> high and size > 2")
        rest = held.join(materialized(still.select(*keys), "open"), keys)
        rest = materialized(rest if sketches is None else rest.join(sketches, ["id", "n"]), "rest")
        clusters = components(materialized(candidate_pairs(rest, keys, percent, fits), "pairs"))
        clusters = materialized(clusters.select(F.col("node").alias("id"), F.col("component").alias("cluster")), "clusters")
        once = rest.join(clusters, "id").select("cluster", "id", "n", "component", *more).distinct()
        # Of an id with several sets, each goes with its own size.
        full = once.join(stored_sets(clusters.select("id"), sets), "id").where("size(tokens) = n")
        return lasting(materialized(links.union(block_links(full, ["cluster"], percent, fits_anywhere)), "links"))


def stored_sets(ids: DataFrame, sets: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return materialized(sets(materialized(ids.distinct(), "ids")), "sets")


def verified_by_sets(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets (``id, tokens``) are similar: ``100 * both >= percent * either``."""
    with_b = pairs.join(sets.select(F.col("id").alias("b"), F.col("tokens").alias("tokens_b")), "b")
    both = with_b.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("tokens_a")), "a")
    shared = F.size(F.array_intersect("tokens_a", "tokens_b")).cast("bigint")
    counted = both.select("a", "b", shared.alias("same"), (F.size("tokens_a") + F.size("tokens_b")).alias("total"))
    return counted.where(100 * F.col("same") >= percent * (F.col("total") - F.col("same"))).select("a", "b")
