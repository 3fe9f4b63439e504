"""Isolation forest (Liu, Ting and Zhou 2008), grown and applied as Spark jobs.

Trees are grown side by side on small samples, one group per tree; the resulting table of nodes is
bounded by ``trees * 2 * max_samples`` whatever the number of rows, and is all that is sent to the
scoring tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from aerolens.operators.statistics import exact_quantiles, settled, with_scalar
from aerolens.session import materialized

NODES = (
    "tree_id int, node_id int, feature int, threshold double, left int, right int,"
    " path double, sample_size int"
)
MAX_NODES = 4_000_000
_SCALE = 1 << 53
_EULER = 0.5772156649015329


def average_path(size: int) -> float:
    """Mean path length of an unsuccessful search among ``size`` values."""
    if size <= 1:
        return 0.0
    if size == 2:
        return 1.0
    return 2.0 * (math.log(size - 1) + _EULER) - 2.0 * (size - 1) / size


def _uniform(*values) -> str:
    """A number in [0, 1) that depends on the given values only, not on partitioning."""
    return f"(pmod(xxhash64({', '.join(map(str, values))}), {_SCALE}L) / {float(_SCALE)}D)"


def sample_per_tree(
    df: DataFrame, key: str, features: list[str], trees: int, max_samples: int, seed: int
) -> DataFrame:
    """About ``max_samples`` rows for each tree, a row possibly for several trees.

    One hash per row first picks a pool that does not grow with the table; only pool rows are then
    considered for every tree. Copies of a key collapse before they meet.
    """
    pool_size = trees * max_samples
    # A margin of four deviations, so that a tree hardly ever gets fewer rows than it may use.
    wanted = max_samples + 4 * math.sqrt(max_samples)
    total = df.agg(F.expr("count(*) as rows"))
    pool = (
        with_scalar(df.select(key, *features), total, "_t")
        .where(f"{_uniform(seed, -1, key)} < {float(pool_size)}D / _t.rows")
        .withColumn("_share", F.expr(f"{wanted}D / least(_t.rows, {pool_size})"))
        .drop("_t")
        .dropDuplicates([key])
    )
    chosen = f"filter(sequence(0, {trees - 1}), tree -> {_uniform(seed, 'tree', key)} < _share)"
    return pool.withColumn("tree_id", F.expr(f"explode({chosen})")).selectExpr(
        "tree_id",
        f"{_uniform(seed, 'tree_id', key)} as place",
        *[f"cast({c} as double) as {c}" for c in features],
    )


def grow_tree(rows: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Nodes of one tree: split at random until a row stands alone or the depth limit is met."""
    limit = math.ceil(math.log2(max(len(rows), 2)))
    nodes: list = [None]
    todo = [(0, rows, 0)]
    while todo:
        node, members, depth = todo.pop()
        low, high = members.min(axis=0), members.max(axis=0)
        open_features = np.flatnonzero(low < high)
        if depth >= limit or len(members) <= 1 or len(open_features) == 0:
            nodes[node] = (-1, 0.0, -1, -1, depth + average_path(len(members)))
            continue
        feature = int(rng.choice(open_features))
        threshold = float(rng.uniform(low[feature], high[feature]))
        goes_left = members[:, feature] <= threshold
        left, right = len(nodes), len(nodes) + 1
        nodes += [None, None]
        nodes[node] = (feature, threshold, left, right, 0.0)
        todo += [(left, members[goes_left], depth + 1), (right, members[~goes_left], depth + 1)]
    return nodes


def fit_isolation_forest(
    df: DataFrame,
    features: list[str],
    *,
    trees: int = 100,
    max_samples: int = 256,
    seed: int = 42,
    key: str = "record_id",
    medians: DataFrame | None = None,
) -> DataFrame:
    """The table of tree nodes. Missing values count as the median of the frame."""
    filled = with_scalar(df.select(key, *features), _medians(df, features, medians), "_m").selectExpr(
        key, *[f"{_filled(c)} as {c}" for c in features]
    )
    samples = sample_per_tree(filled, key, features, trees, max_samples, seed)

    def grow(members: pd.DataFrame) -> pd.DataFrame:
        tree_id = int(members["tree_id"].iloc[0])
        rows = members.nsmallest(max_samples, "place")[features].to_numpy(dtype=float)
        nodes = grow_tree(rows, np.random.default_rng([seed, tree_id]))
        table = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "right", "path"])
        table.insert(0, "node_id", range(len(table)))
        table.insert(0, "tree_id", tree_id)
        table["sample_size"] = len(rows)
        return table

    # The samples are small but growing is work: a fixed number of partitions keeps them apart.
    tasks = min(trees, df.sparkSession.sparkContext.defaultParallelism)
    return samples.repartition(tasks, "tree_id").groupBy("tree_id").applyInPandas(grow, NODES)


def _medians(df: DataFrame, features: list[str], medians: DataFrame | None) -> DataFrame:
    return exact_quantiles(df, features) if medians is None else medians.select(*features)


def _filled(column: str) -> str:
    return f"coalesce(cast({column} as double), _m.{column}, 0.0D)"


class _Forest:
    """Node arrays of all trees behind each other; a leaf points to itself."""

    def __init__(self, nodes: pd.DataFrame):
        nodes = nodes.sort_values(["tree_id", "node_id"], ignore_index=True)
        sizes = nodes.groupby("tree_id").size().to_numpy()
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        offset = np.repeat(starts, sizes)
        own = np.arange(len(nodes))
        leaf = nodes["feature"].to_numpy() < 0
        self.roots = starts.astype(np.int32)
        self.feature = np.where(leaf, 0, nodes["feature"]).astype(np.int32)
        self.threshold = nodes["threshold"].to_numpy()
        left = np.where(leaf, own, nodes["left"] + offset)
        right = np.where(leaf, own, nodes["right"] + offset)
        self.children = np.column_stack([left, right]).ravel().astype(np.int32)
        self.path = nodes["path"].to_numpy()
        sample_size = int(nodes["sample_size"].max())
        self.depth = math.ceil(math.log2(max(sample_size, 2)))
        self.normal = max(average_path(sample_size), 1e-12)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1), higher for rows that are isolated sooner."""
        scores = np.empty(len(rows))
        for start in range(0, len(rows), 1024):
            part = np.ascontiguousarray(rows[start : start + 1024])
            base = (np.arange(len(part)) * part.shape[1])[:, None]
            flat = part.ravel()
            node = np.repeat(self.roots[None, :], len(part), axis=0)
            for _ in range(self.depth):
                goes_right = flat[base + self.feature[node]] > self.threshold[node]
                node = self.children[2 * node + goes_right]
            scores[start : start + 1024] = np.exp2(-self.path[node].mean(axis=1) / self.normal)
        return scores


def score_isolation_forest(
    df: DataFrame,
    nodes: DataFrame,
    features: list[str],
    *,
    name: str = "isolation_score",
    medians: DataFrame | None = None,
) -> DataFrame:
    """Add the anomaly score of every row.

    Reads the node table to the driver (its size is checked) and sends it to the tasks once.
    """
    table = nodes.limit(MAX_NODES + 1).toPandas()
    if len(table) > MAX_NODES:
        raise ValueError(f"a forest may have at most {MAX_NODES} nodes")
    if table.empty:
        return df.withColumn(name, F.lit(None).cast("double"))
    shared = df.sparkSession.sparkContext.broadcast(_Forest(table))

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(np.column_stack([c.to_numpy(dtype=float) for c in columns])))

    filled = with_scalar(df, _medians(df, features, medians), "_m")
    return filled.withColumn(name, score(*[F.expr(_filled(c)) for c in features])).drop("_m")


def isolation_outliers(
    df: DataFrame,
    nodes: DataFrame,
    features: list[str],
    *,
    contamination: float = 0.05,
    medians: DataFrame | None = None,
    name: str = "is_isolation_outlier",
    narrow: bool = True,
) -> DataFrame:
    """Score all rows and flag the most isolated share.

    Scores are computed in Python once and written; the exact limit and the flags then
    come from the stored scores. ``narrow`` as in ``exact_quantiles``.
    """
    scored = materialized(score_isolation_forest(df, nodes, features, medians=medians), "scores")
    limit = settled(exact_quantiles(scored, ["isolation_score"], 1.0 - contamination, narrow=narrow)).scalar()
    return scored.withColumn(name, F.coalesce(F.col("isolation_score") > limit, F.lit(False)))


def stream_forest_scores(df: DataFrame, pm25_nodes: DataFrame, co2_nodes: DataFrame) -> DataFrame:
    """Mean score of two one-feature forests, as the batch detector uses once it has a baseline."""
    scored = score_isolation_forest(df, pm25_nodes, ["pm25"], name="_pm25_score")
    scored = score_isolation_forest(scored, co2_nodes, ["co2_ppm"], name="_co2_score")
    return scored.withColumn("anomaly_score", F.expr("(_pm25_score + _co2_score) / 2")).drop(
        "_pm25_score", "_co2_score"
    )
