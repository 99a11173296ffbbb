"""Numeric coercion and exact unit scaling."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Result types of decimal arithmetic. Spark derives wider types by itself and gives
# up scale beyond 38 digits, so each step is cast back to one of these. Amounts have 20 digits
# before the point, in units or millions, and ten after it; a product with a rate, a quotient
# by one, and a rescaled amount keep all ten within the 38 digits that Spark computes with.
MONEY = DecimalType(18, 2)
AMOUNT = DecimalType(30, 10)
RATE = DecimalType(12, 6)

# Fixed value: the unit of consolidated reports and of the detail ledgers.
MILLION = Decimal("1000000")
MILLIONTH = Decimal("0.000001")

# Java's parser also takes a type suffix ("1d", "1f"), which is not a number in a sheet.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INFINITY = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def to_float(c: Column) -> Column:
    """Double, NULL for anything unparsable (including NaN spellings)."""
    return F.when(c.rlike(_NUMBER) | c.rlike(_INFINITY), c.try_cast("double"))


def to_int(c: Column) -> Column:
    """Integer, NULL for anything unparsable or out of range.

    A fractional cell is rounded half up, as a database does on assignment.
    """
    return F.round(to_float(c)).try_cast("int")


def to_long(c: Column) -> Column:
    """The same for 64 bits, by way of a decimal, which keeps all digits."""
    return F.round(F.when(c.rlike(_NUMBER), F.trim(c).try_cast("decimal(38,10)"))).try_cast("bigint")


def zero_default(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def is_decimal(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, DecimalType)


def rescale(df: DataFrame, name: str, factor: Decimal) -> DataFrame:
    """Multiply a measure by a million or a millionth; decimals keep ten digits after the point."""
    if not is_decimal(df, name):
        return df.withColumn(name, F.col(name) * F.lit(float(factor)))
    return df.withColumn(name, (F.col(name).cast(AMOUNT) * F.lit(factor)).cast(AMOUNT))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL on a zero denominator (plain division raises under ANSI mode)."""
    return numerator / F.nullif(denominator, F.lit(0))
