"""Proportional allocation of cost pools by man-months and effort.

Totals per date are grouped (with map-side partial sums) and joined back, rather than
computed in a window that would bring all rows of a date into one task. There is one
total per DATE value, at most 3.7 million, so totals are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import safe_divide
from ledgerloom.operators.lookup import Lookup, lookup_join

# Fixed value: the department name of the effort no named department used.
OVERHEAD = "Overhead"


def ratio(value: Column) -> Column:
    return value.cast("double")


def sum_by_date(df: DataFrame, value: str, alias: str) -> DataFrame:
    return df.groupBy("date").agg(F.sum(value).alias(alias))


def join_by_date(df: DataFrame, per_date: DataFrame, how: str = "left") -> DataFrame:
    """Join a table of one row per date."""
    side = per_date.withColumnRenamed("date", "__date")
    joined = df.join(F.broadcast(side), F.col("date") == F.col("__date"), how)
    return joined.drop("__date")


def with_total(df: DataFrame, value: str, alias: str, where: Column | None = None) -> DataFrame:
    """Add each date's sum of ``value`` to all its rows; ``where`` limits the rows summed up.

    Rows without a date form a group of their own, as in a window partition.
    """
    counted = F.col(value) if where is None else F.when(where, F.col(value))
    totals = df.groupBy(F.col("date").alias("__date")).agg(F.sum(counted).alias(alias))
    return df.join(F.broadcast(totals), F.col("date").eqNullSafe(F.col("__date")), "left").drop("__date")


def share(man_months: Column, pool: Column, total: Column) -> Column:
    return safe_divide(ratio(man_months) * ratio(pool), ratio(total))


def allocate_full(base: DataFrame, pool: DataFrame) -> DataFrame:
    """Every base row with every pool row of its date, and both sides' rows without a partner.

    The emitted date is the base's, so a pool row of a date without base rows has none.
    The full join is a left join plus the partnerless pool rows; both halves can
    broadcast, while a shuffled full join would put each date into a single task.
    """
    pool = pool.withColumnRenamed("date", "__pool_date")
    matched = lookup_join(base, Lookup(pool), [(F.col("date"), F.col("__pool_date"))])
    dates = base.select(F.col("date").alias("__pool_date")).distinct()
    alone = pool.join(F.broadcast(dates), "__pool_date", "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True).drop("__pool_date")


def with_overhead_rows(effort: DataFrame, is_pool: Column) -> DataFrame:
    """Effort rows, and those outside the pool department once more under ``OVERHEAD``."""
    again = effort.filter(~is_pool).withColumn("department_code", F.lit(OVERHEAD))
    return effort.unionByName(again)


def allocate_effort(effort: DataFrame, is_pool: Column) -> DataFrame:
    """Pool cost by effort; ``OVERHEAD`` gets the pool's man-months that nobody used.

    ``effort`` has date, department_code, effort, expense_value and man_month_value.
    Rows are summed by department first, and only those sums are doubled for overhead.
    """
    sums = effort.groupBy("date", "department_code").agg(
        F.sum("effort").alias("effort"),
        F.sum("expense_value").alias("expense_sum"),
        F.count("expense_value").alias("expense_rows"),
        F.sum("man_month_value").alias("man_month_sum"),
        F.count("man_month_value").alias("man_month_rows"),
    )
    total = with_overhead_rows(sums, is_pool).groupBy("date", "department_code")
    total = total.agg(*[F.sum(c).alias(c) for c in sums.columns if c not in ("date", "department_code")])
    expense = safe_divide(ratio(F.col("expense_sum")), F.col("expense_rows"))
    man_month = safe_divide(ratio(F.col("man_month_sum")), F.col("man_month_rows"))
    effort_sum = ratio(F.col("effort"))
    value = F.when(F.col("department_code") == OVERHEAD, man_month - effort_sum).otherwise(effort_sum)
    return total.select(
        "date",
        "department_code",
        value.alias("value"),
        safe_divide(value * expense, man_month).alias("distribution_regular"),
    )


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])
