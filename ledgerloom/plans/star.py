"""The conformed tables and dimensions a dataset reads."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.lookup import Lookup
from ledgerloom.operators.pnl import department_dim, expense_dim
from ledgerloom.sources.tables import read

Tables = Mapping[str, DataFrame]


class CatalogTables(dict):
    """Tables of one catalog schema, opened by name when first asked for."""

    def __init__(self, spark: SparkSession, layer: str):
        super().__init__()
        self.spark, self.layer = spark, layer

    def __missing__(self, name: str) -> DataFrame:
        self[name] = read(self.spark, self.layer, name)
        return self[name]


@dataclass
class Star:
    """The two dimensions every dataset is enriched with.

    Each is joined up to a few dozen times, so it is written once with its names.
    """

    expense: Lookup
    department: Lookup

    @property
    def is_small(self) -> bool:
        return self.expense.is_small and self.department.is_small

    @property
    def shuffles_once(self) -> bool:
        """Does no more than one join shuffle facts? It comes first (``pnl.enrich``), so detail
        rows and their sums shuffle the same columns, which the plan then does once for both."""
        return self.department.is_small

    @cached_property
    def codes_are_unique(self) -> bool:
        """Does a code, in whatever case, find one row of its dimension at most? If so, rows that
        carry a dimension's code find the same row again. Counted once, where they are counted."""
        known = self.expense.df.select(F.lit("expense").alias("of"), F.upper("expense_code").alias("code")).unionByName(
            self.department.df.select(F.lit("department").alias("of"), F.upper("department_code").alias("code"))
        )
        repeated = known.filter("code is not null").groupBy("of", "code").count().filter("count > 1")
        return repeated.isEmpty()

    @classmethod
    def of(cls, tables: Tables) -> "Star":
        expense = expense_dim(tables["dim_expense_type"], tables["dim_expense_type_5"])
        department = department_dim(tables["dim_department"], tables["dim_ob"])
        return cls(Lookup.written(expense), Lookup.written(department))
