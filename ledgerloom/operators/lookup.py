"""Dimension lookups that hold for small and large dimensions and for hot keys.

A dimension is broadcast only after its bytes have been measured. Above the limit the
join shuffles both sides once: rows without a key get a salt that nothing matches, so
they spread, and AQE splits the partitions of keys that hold very many rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.sources.workspace import materialised

# Bytes up to which a measured dimension is broadcast.
BROADCAST_BYTES = 100 << 20

# Bytes of a measured dimension that a task of a shuffled join may hold as a hash table.
HASHED_BYTES = BROADCAST_BYTES // 4

# Places among which the rows without a key are dealt in a shuffled join.
SALTS = 4096


def _width(df: DataFrame) -> Column:
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if isinstance(f.dataType, StringType)]
    return F.coalesce(F.sum(reduce(Column.__add__, texts, F.lit(8 * (len(df.columns) + 1)))), F.lit(0))


@dataclass
class Lookup:
    """A dimension to join facts with; measured once, on first use."""

    df: DataFrame
    broadcast_bytes: int = BROADCAST_BYTES
    _bytes: int | None = field(default=None, repr=False)

    @classmethod
    def bounded(cls, df: DataFrame) -> "Lookup":
        """A dimension small by construction, such as one row per month; not measured."""
        return cls(df, _bytes=0)

    @classmethod
    def written(cls, df: DataFrame) -> "Lookup":
        """A dimension that is written once and measured as it is written."""
        seen = Observation()
        stored = materialised(df.observe(seen, _width(df).alias("bytes")))
        return cls(stored, _bytes=seen.get["bytes"])

    @property
    def bytes(self) -> int:
        """Its size in memory: 8 bytes a column and row, and the lengths of its texts."""
        if self._bytes is None:
            self._bytes = self.df.agg(_width(self.df)).first()[0]
        return self._bytes

    @property
    def is_small(self) -> bool:
        return self.bytes <= self.broadcast_bytes

    def where(self, condition: Column) -> "Lookup":
        """The dimension's matching rows; a small one is not measured again."""
        return replace(self, df=self.df.filter(condition), _bytes=self.bytes if self.is_small else None)


def lookup_join(rows: DataFrame, lookup: Lookup, on: list[tuple[Column, Column]], how: str = "left") -> DataFrame:
    """Join ``rows`` to ``lookup`` on pairs of (row expression, lookup expression).

    Keeps the columns of both sides, duplicates in the lookup multiply rows as in SQL.
    """
    keys = [f"__key_{i}" for i in range(len(on))]
    left = rows.withColumns({k: pair[0] for k, pair in zip(keys, on)})
    right = lookup.df.withColumns({k: pair[1] for k, pair in zip(keys, on)})
    if lookup.is_small:
        joined = left.join(F.broadcast(right), keys, how)
    else:
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # rows then need no sorting, which would spill
        right = right.hint("shuffle_hash") if lookup.bytes <= HASHED_BYTES * tasks else right
        joined = _shuffled(left, right, keys, how)
    return joined.drop(*keys)


def _shuffled(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """One shuffle of either side. NULL never matches, and would hash to one task."""
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    if how == "inner":
        return left.filter(has_key).join(right, keys, how)
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(SALTS)) + 1
    left = left.withColumn("__salt", F.when(has_key, F.lit(0)).otherwise(spread))
    # always 0, but not a constant, which would turn the salt into a filter of the join
    right = right.withColumn("__salt", F.pmod(F.xxhash64(*keys), F.lit(1)))
    return left.join(right, [*keys, "__salt"], how).drop("__salt")
