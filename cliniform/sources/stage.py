"""Intermediate tables on shared storage, for a node that several branches read."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_own: dict[str, str] = {}


def stage_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Unset on a cluster is an error: executors would each write to a disk that no other sees. With a
    local master, where driver and tasks are one process, an own folder is made and removed at exit.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="cliniform-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return _own[app]


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files: their plan ends with them, so nothing reads the files again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def release(spark: SparkSession) -> None:
    """Between two tables of a run: let go of the plans and broadcasts of the one before.

    Spark drops them when the driver collects its garbage, which a driver with room left puts off while its
    memory grows from table to table.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a node once and read it back: its lineage ends here with its shuffle files, and readers still prune
    columns and, with ``by``, whole value folders."""
    spark = df.sparkSession
    path = f"{stage_root(spark)}/cliniform/{uuid4().hex}/{name}"
    writer = df.write.partitionBy(by) if by else df.write
    with shuffles_removed(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
