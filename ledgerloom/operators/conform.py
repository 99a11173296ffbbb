"""Clean facts and dimensions: normalised keys, defaults, rows that carry nothing left out."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property, reduce
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import zero_default
from ledgerloom.functions.text import MISSING_KEY, default_text, norm_key, norm_text, trimmed_key

# Keys that stand for "no key" in the ledgers.
PLACEHOLDER_KEYS = (MISSING_KEY, "0")


@dataclass(frozen=True)
class Text:
    """An attribute of a fact or dimension."""

    name: str
    rule: Literal["key", "trim", "default", "keep"] = "trim"
    default: str = MISSING_KEY
    alias: str | None = None

    def column(self) -> Column:
        c = F.col(self.name)
        if self.rule == "key":
            c = norm_key(c)
        elif self.rule == "trim":
            c = norm_text(c, self.default)
        elif self.rule == "default":
            c = default_text(c, self.default)
        return c.alias(self.alias or self.name)


@dataclass(frozen=True)
class FactSpec:
    """How one ledger is conformed. A row is rejected when all its measures are zero.

    Many ledgers share a spec; its expressions are built once.
    """

    measures: tuple[str, ...] = ("financial_report_value", "management_report_value")
    keys: tuple[str, ...] = ("expense_code", "department_code")
    texts: tuple[Text, ...] = ()
    excluded: dict[str, tuple[str, ...]] = field(default_factory=dict)
    date: str = "accounting_date"

    @cached_property
    def columns(self) -> list[Column]:
        return [
            F.col(self.date),
            *[zero_default(F.col(m)).alias(m) for m in self.measures],
            *[norm_key(F.col(k)).alias(k) for k in self.keys],
            *[t.column() for t in self.texts],
        ]

    @cached_property
    def kept(self) -> Column:
        """True for loaded rows that carry a measure and have their keys.

        Placeholders hold no letters, so keys are compared with them unfolded.
        """
        all_zero = reduce(lambda a, b: a & b, [zero_default(F.col(m)) == 0 for m in self.measures])
        left_out = [trimmed_key(F.col(k)).isin(*PLACEHOLDER_KEYS) for k in self.keys]
        left_out += [norm_key(F.col(k)).isin(*codes) for k, codes in self.excluded.items()]
        return ~(all_zero | reduce(lambda a, b: a | b, left_out))


@dataclass(frozen=True)
class DimSpec:
    columns: tuple[Text, ...]


def conform_fact(df: DataFrame, spec: FactSpec) -> DataFrame:
    return df.filter(spec.kept).select(*spec.columns)


def conform_dim(df: DataFrame, spec: DimSpec) -> DataFrame:
    return df.select(*[t.column() for t in spec.columns])
