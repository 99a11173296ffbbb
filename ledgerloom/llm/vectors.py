"""What the two vector operators share: checked vectors, rotations, groups of sorted rows."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def taking_part(column: str) -> F.Column:
    """True for vectors without null or non-finite components that are not zero."""
    x = F.col(column)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.coalesce(finite & F.exists(x, lambda c: c != 0), F.lit(False))


def dimension(rows: DataFrame, column: str) -> int:
    """The length of the vectors; unequal lengths are refused."""
    low, high = rows.agg(F.min(F.size(column)), F.max(F.size(column))).first()
    if low != high:
        raise ValueError(f"vectors of {low} to {high} components")
    return low or 0


def rotation(size: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """A column of lists as rows of double precision."""
    return column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(column), size)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings the largest component below one: directions and
    cosines keep every digit, and squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0.0))[1])


def units(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of the rows that agree in the first ``keys`` columns, from sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = zip(*(batch.column(k).to_pylist() for k in range(keys)), strict=True)
        at = 0
        for key, same in groupby(rows):
            n = len(list(same))
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(at, n))
            last, at = key, at + n
    if held:
        yield pa.Table.from_batches(held)
