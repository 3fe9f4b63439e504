"""What several corpus operators share: input columns, Arrow batches, ASCII words, distributed ranks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerolens.session import configure

#: The six ASCII characters that end a word: blank, tab, line feed, vertical tab, form feed, return.
ASCII_SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: A null id counts as one id above all others.
NULL_ID = 2**63 - 1
ARROW_ROWS = 500


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """A table of the given folder, and a session with this package's settings."""
    prepared(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def prepared(spark: SparkSession) -> SparkSession:
    """Settings of all jobs here; Arrow batches are kept small, as single texts can be very long."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def id_key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("bigint"), F.lit(NULL_ID))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` does the same, and faster, where a text is all ASCII."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def fold_ascii(text: str) -> str:
    """Lower-case A-Z and nothing else."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def ranked(df: DataFrame, group: Sequence[str], order: str, ties: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """Add running totals inside each group without bringing a group together in one task.

    ``order`` is a column of hexadecimal digest texts, evenly spread. Its first three digits cut every
    group into 4,096 cells. The totals of the cells are small and are summed up first; the window then runs
    inside single cells. ``sums`` names a result column for each summed column: the total of all rows
    before this one, by ``order`` and then ``ties``.
    """
    cell = F.substring(order, 1, 3)
    cells = df.groupBy(*group, cell.alias("_cell")).agg(*(F.sum(c).alias(f"_cell_{c}") for c in sums.values()))
    before = [
        F.coalesce(F.sum(f"_cell_{c}").over(_before(group, ["_cell"])), F.lit(0)).alias(f"_before_{c}")
        for c in sums.values()
    ]
    starts = cells.select(*group, "_cell", *before)
    joined = df.withColumn("_cell", cell).join(
        starts.select(*(F.col(c).alias(f"_of_{c}") for c in group), F.col("_cell").alias("_of_cell"), *(
            f"_before_{c}" for c in sums.values()
        )),
        [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group] + [F.col("_cell") == F.col("_of_cell")],
    )
    inner = _before([*group, "_cell"], [order, *ties])
    totals = {
        name: F.col(f"_before_{c}") + F.coalesce(F.sum(c).over(inner), F.lit(0)) for name, c in sums.items()
    }
    return joined.withColumns(totals).drop(
        "_cell", "_of_cell", *(f"_of_{c}" for c in group), *(f"_before_{c}" for c in sums.values())
    )


def _before(group: Sequence[str], order: Sequence[str]):
    from pyspark.sql import Window

    return Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

