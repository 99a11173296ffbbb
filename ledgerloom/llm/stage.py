"""Tables, written stages and Arrow helpers that the operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import fresh_folder, shuffles_removed


def ship(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has it;
    elsewhere it has to be installed or sent with ``--py-files``, as any library."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """A fresh folder in the shared folder for the written stages of one run.

    ``save`` writes a frame and reads it back, so a lost executor costs no rerun of what
    came before; ``drop`` deletes a stage that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{fresh_folder(spark)}/{name}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def save(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        path = self.path(name)
        with shuffles_removed(self.spark):
            writer = df.write.option("compression", "zstd")
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


PORTION = 1 << 20


def portions(batches: Iterable[pa.RecordBatch], limit: int = PORTION) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts and binaries have about ``limit`` bytes, or of one
    row: bounds what a task holds in memory at once."""
    for batch in batches:
        size = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                size += np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: batch.num_rows + 1])
        portion = np.cumsum(size) // limit
        starts = np.flatnonzero(np.diff(portion, prepend=-1))
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def mapped(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` of a function of one portion of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            if (out := function(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> pa.StringArray:
    """A text column with nulls as empty texts."""
    return column.fill_null("").cast(pa.string())


def utf8(array: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts together and the offsets of each, from 0."""
    offsets = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1]
    if not len(array) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    data = np.frombuffer(array.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets.astype(np.int64) - offsets[0]


def binary(array: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The same of a binary column without nulls."""
    return utf8(array)


def slices(values: np.ndarray, bounds: np.ndarray) -> pa.LargeBinaryArray:
    """Little-endian bytes of ``values`` cut at ``bounds`` (indices of values)."""
    flat = np.ascontiguousarray(values)
    offsets = (np.asarray(bounds, np.int64) * flat.itemsize).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(flat)]
    )


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order, by sorting."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def packed(docs: DataFrame, *names: str, without: tuple[str, ...] = ()) -> DataFrame:
    """The named columns and a struct ``rest`` of the others, so that no name can clash."""
    taken = {n.lower() for n in (*names, *without)}
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken]
    return docs.select(*names, F.struct(*others, F.lit(0).alias("_")).alias("rest"))


def unpacked(rows: DataFrame, *names: str) -> DataFrame:
    """The inverse: the first columns of ``names`` in place, then what ``rest`` holds."""
    others = [f for f in rows.schema["rest"].dataType.names if f != "_"]
    return rows.select(*names[:2], *(F.col(f"rest.`{c}`").alias(c) for c in others), *names[2:])
