"""A uniform sample of all rows seen so far, of bounded size and kept from batch to batch.

Each row has a place, a digest of its key and a seed. The sample is the ``size`` rows of the lowest places, so it
does not depend on how the rows were cut into batches, on their order or on partitioning, and the samples of two
parts merge into the sample of both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from aerolens.operators.statistics import with_scalar

PLACE = "place"


def with_place(df: DataFrame, keys: list[str], values: list[str], seed: int = 42) -> DataFrame:
    """Keys, values and the place of every row; a time in a key counts in microseconds.

    A null in a key counts as an empty text. Rows of one key are one row, the one of the least values.
    """
    kinds = dict(df.dtypes)
    texts = [f"unix_micros({c})" if kinds[c] == "timestamp" else c for c in keys]
    parts = ", ".join(f"coalesce(cast({text} as string), '')" for text in texts)
    placed = df.withColumn(PLACE, F.expr(f"md5(concat_ws(':', '{seed}', {parts}))"))
    least = placed.groupBy(PLACE, *keys).agg(F.min(F.struct(*values)).alias("_values"))
    return least.select(*keys, PLACE, *[f"_values.{c}" for c in values])


def lowest_places(placed: DataFrame, keys: list[str], size: int) -> DataFrame:
    """The ``size`` rows of the lowest places, all rows if there are fewer.

    Rows are counted by the first four digits of their places, 65,536 cells at most. Only rows up to the cell in
    which the last wanted row lies are sorted, so what reaches the last task is ``size`` rows and one cell.
    """
    cell = F.substring(PLACE, 1, 4)
    counted = placed.groupBy(cell.alias("cell")).agg(F.count("*").alias("rows"))
    earlier = F.sum("rows").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    last = counted.withColumn("earlier", F.coalesce(earlier, F.lit(0))).where(F.col("earlier") < size).agg(
        F.max("cell").alias("cell")
    )
    near = with_scalar(placed, last, "_last").where(cell <= F.col("_last.cell")).drop("_last")
    return near.orderBy(PLACE, *keys).limit(size)


def merged_sample(
    before: DataFrame | None, df: DataFrame, keys: list[str], values: list[str], *, size: int, seed: int = 42
) -> DataFrame:
    """The sample of all rows, from the one before and the rows that have come.

    Once the sample is full, rows beyond its last place are left out where they are read. ``before`` must have been
    taken with the same size and seed, or a larger size.
    """
    if before is None:
        return lowest_places(with_place(df, keys, values, seed), keys, size)
    full = before.agg(F.expr(f"if(count(*) >= {size}, max({PLACE}), null) as place"))
    fresh = with_scalar(with_place(df, keys, values, seed), full, "_full")
    fresh = fresh.where(f"_full.place is null or {PLACE} <= _full.place").drop("_full")
    columns = [*keys, PLACE, *values]
    both = before.select(*columns).unionByName(fresh.select(*columns))
    one = both.groupBy(*keys, PLACE).agg(F.min(F.struct(*values)).alias("_values"))
    return lowest_places(one.select(*keys, PLACE, *[f"_values.{c}" for c in values]), keys, size)
