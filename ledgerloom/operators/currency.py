"""Currency conversion by monthly rates.

Rates need not be unique per month: a second rate for a month doubles its rows, as a
join does. ``quality.duplicates`` reports such months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_start
from ledgerloom.functions.numbers import AMOUNT, RATE, is_decimal, safe_divide
from ledgerloom.operators.lookup import Lookup, lookup_join


def rate_lookup(rates: DataFrame, *departments: str) -> Lookup:
    """The departments' rates: ``rate_of``, ``rate_month``, ``rate_source`` (if tagged), ``rate``."""
    source = [F.col("source").alias("rate_source")] if "source" in rates.columns else []
    rate = F.col("rate_value").cast(RATE) if is_decimal(rates, "rate_value") else F.col("rate_value")
    return Lookup(
        rates.filter(F.col("department_code").isin(*departments)).select(
            F.col("department_code").alias("rate_of"),
            month_start(F.col("accounting_date")).alias("rate_month"),
            *source,
            rate.alias("rate"),
        )
    )


def fx_divide(df: DataFrame, rates: Lookup, date: str, value: str) -> DataFrame:
    """Value over the month's rate (of one department); unchanged where the month has none."""
    joined = lookup_join(df, rates, [(month_start(F.col(date)), F.col("rate_month"))])
    quotient = safe_divide(F.col(value), F.coalesce(F.col("rate"), F.lit(1).cast(rates.df.schema["rate"].dataType)))
    if is_decimal(df, value):
        quotient = quotient.cast(AMOUNT)
    return joined.withColumn(value, quotient).select(*df.columns)


def fx_multiply(df: DataFrame, rates: Lookup, date: str, value: str) -> DataFrame:
    """Value times the rate of its month, source and ``rate_department``; unchanged where there is none."""
    on = [
        (month_start(F.col(date)), F.col("rate_month")),
        (F.col("source"), F.col("rate_source")),
        (F.col("rate_department"), F.col("rate_of")),
    ]
    joined = lookup_join(df, rates, on)
    v = F.col(value).cast(AMOUNT) if is_decimal(df, value) else F.col(value)
    product = v * F.col("rate")
    if is_decimal(df, value):
        product = product.cast(AMOUNT)
    return joined.withColumn(value, F.when(F.col("rate").isNull(), v).otherwise(product)).select(*df.columns)
