"""Session settings and the shared folder that long jobs write to."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# Settings that change results (time zone) or let Spark re-plan at run time.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_shipped: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings every job here relies on and send this package to the executors."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(
            str(Path(tempfile.mkdtemp(prefix="aerolens-")) / package.name), "zip", package.parent, package.name
        )
        context.addPyFile(archive)  # Spark copies it to every executor
        _shipped.add(context.applicationId)
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="aerolens-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster that
    folder would exist on one machine only.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for one run below the shared folder."""
    return f"{shared_folder(spark)}/aerolens/{name}-{uuid.uuid4().hex}"


#: Shuffle files go when the execution that wrote them ends, not when the driver happens to collect its garbage.
SHUFFLES_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What was written in each of the open blocks, the innermost last.
_made: ContextVar[tuple[list[str], ...]] = ContextVar("made", default=())
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Remove what ``materialized`` writes inside this block, but what ``lasting`` takes out of it."""
    from aerolens.sources.folders import remove

    made: list[str] = []
    outer = _made.set((*_made.get(), made))
    try:
        yield
    finally:
        _made.reset(outer)
        for path in made:
            remove(spark, path)


def lasting(stored: DataFrame) -> DataFrame:
    """A table that ``materialized`` wrote in the innermost block; it goes with the block around that, if there is one."""
    *outer, made = _made.get()
    made.remove(_paths[stored])
    if outer:
        outer[-1].append(_paths[stored])
    return stored


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: the rows are computed once, survive lost executors, and later steps read only
    the columns they need. The shuffle files of the write are removed with its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _made.get():
        _made.get()[-1].append(path)
    before = spark.conf.get(SHUFFLES_REMOVED, "false")
    spark.conf.set(SHUFFLES_REMOVED, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES_REMOVED, before)
    stored = spark.read.schema(df.schema).parquet(path)
    _paths[stored] = path
    return stored
