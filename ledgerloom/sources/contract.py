"""The column contract that comes with every input table.

A contract is a small sheet: cell B1 names the target table, B2 its time column, and
below a header in row 6 each row maps a source column to a target column and type.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# The sheet's layout (rows count from 1).
TABLE_ROW, TIME_ROW, HEADER_ROW = 1, 2, 6

# Declared type names that are coerced, all others are cleaned as text.
# Accounting is done by the day, so both time types load as dates.
_TYPES: dict[str, DataType] = {
    "timestamp": DateType(),
    "datetime": DateType(),
    "date": DateType(),
    "float": DoubleType(),
    "double": DoubleType(),
    "real": DoubleType(),
    "double precision": DoubleType(),
    "smallint": IntegerType(),
    "int": IntegerType(),
    "integer": IntegerType(),
    "bigint": LongType(),
    "numeric": DecimalType(38, 10),
    "decimal": DecimalType(38, 10),
}


class ContractError(ValueError):
    """The input does not fulfil its contract."""


@dataclass(frozen=True)
class Mapping:
    source: str
    target: str
    type_name: str

    @property
    def data_type(self) -> DataType:
        name, scale = re.fullmatch(r"(.*?)\s*(?:\(([\d\s,]*)\))?", self.type_name.strip().lower()).groups()
        if scale and name in ("numeric", "decimal"):
            precision, *rest = (int(x) for x in scale.split(","))
            return DecimalType(precision, rest[0] if rest else 0)
        return _TYPES.get(name, StringType())


@dataclass(frozen=True)
class Contract:
    table: str
    time_column: str | None
    mappings: tuple[Mapping, ...]

    @property
    def schema(self) -> StructType:
        return StructType([StructField(m.target, m.data_type) for m in self.mappings])

    @classmethod
    def from_cells(cls, cells: DataFrame, fold_case: bool = True) -> "Contract":
        """Read a contract from its cells: columns ``row`` (from 1), ``a``, ``b``, ``c``.

        ``fold_case`` lower-cases the mapped names, as fact loads do with their headers.
        Rows with an empty target or type are dropped.
        """
        mapping = (F.col("row") > HEADER_ROW) & F.col("b").isNotNull() & F.col("c").isNotNull()
        used = cells.filter((F.col("row") <= TIME_ROW) | mapping)
        # a row a declared column: as long as the schema, which the driver holds anyway
        rows = used.select("row", "a", "b", "c").orderBy("row").collect()
        head = {r["row"]: r["b"] for r in rows if r["row"] <= TIME_ROW}
        if not head.get(TABLE_ROW):
            raise ContractError("contract names no table")
        time_column = (head.get(TIME_ROW) or "").strip().lower() or None

        def name(text: str) -> str:
            return text.strip().lower() if fold_case else text

        mappings = tuple(
            Mapping(name(r["a"]), name(r["b"]), r["c"])
            for r in rows
            if r["row"] > HEADER_ROW and r["a"] and r["b"] and r["c"]
        )
        table = head[TABLE_ROW].strip().lower()
        if not re.fullmatch(r"\w+", table):
            raise ContractError(f"not a table name: {table!r}")
        return cls(table, time_column, mappings)
