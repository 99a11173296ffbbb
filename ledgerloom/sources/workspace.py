"""Where intermediate results are kept."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: the session's checkpoint folder.

    Only a local session (a test) may fall back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="ledgerloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside go as soon as each action ends."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


_scopes: list[list[str]] = []


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete the folders of intermediate results that are made inside when the scope ends.

    Frames made inside read these folders, so write what shall last before leaving.
    """
    _scopes.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in _scopes.pop():
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)


def fresh_folder(spark: SparkSession) -> str:
    folder = f"{shared_folder(spark)}/ledgerloom-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(folder)
    return folder


def materialised(df: DataFrame, *partition_by: str) -> DataFrame:
    """Computed once, written to the shared folder and read back.

    Losing an executor then costs no rerun, later steps read only the columns they
    need (and the partitions they filter), and the planner knows the table's size.
    """
    spark = df.sparkSession
    folder = fresh_folder(spark)
    with shuffles_removed(spark):
        writer = df.write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
