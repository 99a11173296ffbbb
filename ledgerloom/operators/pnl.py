"""Plan-versus-actual steps: tag, enrich, classify, subtotal, compare, stack, attach.

Detail rows are never grouped or shuffled here: dimensions and monthly revenue reach
them by broadcast (counted, or bounded by the calendar), and all subtotals come from
one aggregation with map-side partial sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import replace
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.functions.dates import month_index, month_start, year_start
from ledgerloom.functions.text import unit_label
from ledgerloom.operators.lookup import Lookup, lookup_join

# Expense types that are income; the second stays out of profit.
REVENUE_TYPE = 18
OTHER_INCOME_TYPE = 19

# Row classes of the report.
EXPENSE, REVENUE, PROFIT, NET_PROFIT, TOTAL_REVENUE = "e", "r", "p", "np", "str"
DETAIL_TYPES = (EXPENSE, REVENUE)

KeyCase = Literal["upper", "lower", "raw"]
_FOLD: dict[str, Callable[[Column], Column]] = {"upper": F.upper, "lower": F.lower, "raw": lambda c: c}

EXPENSE_COLUMNS = ("expense_code", "expense_type_5_id", "expense_type_5_name")
DEPARTMENT_COLUMNS = (
    "department_code",
    "business_unit_1_id",
    "business_unit_1_name",
    "business_unit_2_id",
    "business_unit_2_name",
    "business_unit_3_id",
    "ob_code",
)


def union_all(frames: Iterable[DataFrame], missing: bool = False) -> DataFrame:
    """All rows of all frames, put together in pairs: a chain of unions would have every frame
    analysed again for each that follows. ``missing`` fills up columns that a frame lacks."""
    frames = list(frames)
    while len(frames) > 1:
        pairs = zip(frames[::2], [*frames[1::2], None], strict=False)
        frames = [a if b is None else a.unionByName(b, allowMissingColumns=missing) for a, b in pairs]
    return frames[0]


def union_facts(facts: Iterable[DataFrame], columns: Iterable[str]) -> DataFrame:
    """All rows of all facts, by an explicit column list."""
    columns = list(columns)
    return union_all(f.select(*columns) for f in facts)


def tag_source(actual: DataFrame, planning: DataFrame) -> DataFrame:
    return actual.withColumn("source", F.lit("actual")).unionByName(planning.withColumn("source", F.lit("planning")))


def expense_dim(expense_type: DataFrame, expense_type_5: DataFrame) -> DataFrame:
    names = expense_type_5.select(
        F.col("expense_type_id").alias("expense_type_5_id"), F.col("expense_type_name").alias("expense_type_5_name")
    )
    return expense_type.join(names, "expense_type_5_id", "left").select(*EXPENSE_COLUMNS)


def department_dim(department: DataFrame, ob: DataFrame) -> DataFrame:
    return department.join(ob.select("ob_id", "ob_code"), "ob_id", "left").select(*DEPARTMENT_COLUMNS)


def enrich(
    fact: DataFrame,
    expense: Lookup,
    department: Lookup,
    key_case: KeyCase = "upper",
    block: str | None = None,
) -> DataFrame:
    """Replace the fact's codes by the matching dimension rows, NULL where there is none.

    With ``block`` only departments of that block stay; the filter is applied to the
    department dimension, and its join comes first and drops the other rows early.
    Both codes are folded before the joins, where the planner can merge this with conforming.
    Where only the expense dimension is too large to broadcast, its join comes first, so that
    no attribute of a department is shuffled; then a semi-join drops the other blocks' rows early.
    """
    fold = _FOLD[key_case]
    codes = {"fact_expense": fold(F.col("expense_code")), "fact_department": fold(F.col("department_code"))}
    rows = fact.withColumns(codes).drop("expense_code", "department_code")
    how = "left"
    if block is not None:
        department, how = department.where(F.col("ob_code") == block), "inner"
    joins = [
        (department, [(F.col("fact_department"), fold(F.col("department_code")))], how),
        (expense, [(F.col("fact_expense"), fold(F.col("expense_code")))], "left"),
    ]
    if department.is_small and not expense.is_small:
        joins.reverse()
        if block is not None:
            kept = department.df.select(fold(F.col("department_code")).alias("fact_department"))
            rows = rows.join(F.broadcast(kept), "fact_department", "left_semi")
    columns = [*[c for c in rows.columns if c not in codes], *department.df.columns, *expense.df.columns]
    for lookup, on, kind in joins:
        rows = lookup_join(rows, lookup, on, kind)
    return rows.select(*[F.col(f"`{c}`") for c in columns])


def month_facts(fact: DataFrame, measures: tuple[str, ...] = ("value",)) -> DataFrame:
    """Facts added up by month and codes: all a subtotal needs, and far fewer rows to shuffle."""
    keys = [c for c in fact.columns if c not in ("date", *measures)]
    return fact.groupBy(*keys, month_start(F.col("date")).alias("date")).agg(*[F.sum(m).alias(m) for m in measures])


def classify(expense_type: Column) -> Column:
    """Income types are revenue rows, all others (also unknown ones) expense rows."""
    return F.when(expense_type.isin(REVENUE_TYPE, OTHER_INCOME_TYPE), F.lit(REVENUE)).otherwise(F.lit(EXPENSE))


def flip_planned_cost(value: Column, expense_type: Column, source: Column) -> Column:
    """Planned costs change sign; rows of unknown type keep theirs."""
    cost = ~expense_type.isin(REVENUE_TYPE, OTHER_INCOME_TYPE)
    return F.when(cost & (source == "planning"), -value).otherwise(value)


def monthly_kinds() -> dict[str, Column | None]:
    """The rows each subtotal adds up (None: all).

    Profit leaves out other income; rows of unknown type count only towards net profit.
    """
    kind = F.col("expense_type_5_id")
    return {PROFIT: kind != OTHER_INCOME_TYPE, NET_PROFIT: None, TOTAL_REVENUE: kind == REVENUE_TYPE}


def consolidated_kinds() -> dict[str, Column | None]:
    """Consolidated profit takes every row, other income included."""
    return {PROFIT: None, TOTAL_REVENUE: F.col("expense_type_5_id") == REVENUE_TYPE}


def period_sums(rows: DataFrame, keys: list[str], kinds: dict[str, Column | None], signed: Iterable[str] = ()) -> DataFrame:
    """Month sums of every kind in one pass: ``keys``, ``date``, ``value_type``, ``value``.

    A group without a qualifying row has no subtotal row. Kinds in ``signed`` count
    expense rows as negative.
    """
    cost_negative = F.when(F.col("value_type") == EXPENSE, -F.col("value")).otherwise(F.col("value"))
    aggregates, cells = [], []
    for kind, condition in kinds.items():
        value = cost_negative if kind in signed else F.col("value")
        qualifies = F.lit(1) if condition is None else F.when(condition, F.lit(1))
        aggregates.append(F.sum(value if condition is None else F.when(condition, value)).alias(f"{kind}_sum"))
        aggregates.append(F.count(qualifies).alias(f"{kind}_rows"))
        cells.append(F.struct(F.col(f"{kind}_sum").alias("value"), F.col(f"{kind}_rows").alias("rows")))
    wide = rows.groupBy(*keys, month_start(F.col("date")).alias("date")).agg(*aggregates)
    places = ", ".join(f"({place}, '{kind}')" for place, kind in enumerate(kinds))
    # as values, so that the planner leaves out what a filter on value_type leaves nothing of
    named = wide.sparkSession.sql(f"SELECT * FROM VALUES {places} AS kinds(place, value_type)")
    return (
        wide.select(*keys, "date", F.posexplode(F.array(*cells)).alias("place", "cell"))
        .join(F.broadcast(named), "place")
        .select(*keys, "date", "value_type", "cell.*")
        .filter(F.col("rows") > 0)
        .drop("rows")
    )


def rollup_year(sums: DataFrame, keys: list[str], kinds: Iterable[str] | None = None) -> DataFrame:
    """Month sums added up to years, for the given kinds (all by default)."""
    date = year_start(F.col("date"))
    if kinds is not None:
        date = F.when(F.col("value_type").isin(*kinds), date).otherwise(F.col("date"))
    return sums.groupBy(*keys, "value_type", date.alias("date")).agg(F.sum("value").alias("value"))


def with_previous(sums: DataFrame, keys: list[str], months: int) -> DataFrame:
    """Add the value of the period ``months`` earlier, NULL where that period is absent.

    A range frame on the month number, so gaps stay gaps. Partitions hold one row per
    period and are bounded by the calendar.
    """
    window = Window.partitionBy(*keys, "value_type").orderBy(month_index(F.col("date"))).rangeBetween(-months, -months)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, "date"]])
    return sums.withColumn("previous_value", F.when(known, F.first("value").over(window)))


def stack_rows(rows: DataFrame, sums: DataFrame, empty_text: Iterable[str]) -> DataFrame:
    """Detail rows over subtotal rows; columns a subtotal lacks are NULL, the given ones ''."""
    absent = set(rows.columns) - set(sums.columns)
    empty = set(empty_text) & absent
    filled = sums.withColumns({c: F.lit("") for c in sorted(empty)}) if empty else sums
    return rows.unionByName(filled, allowMissingColumns=True)


def label_units(rows: DataFrame, plain_ids: Iterable[int] = (0,)) -> DataFrame:
    label = unit_label(
        F.col("business_unit_1_name"), F.col("business_unit_2_id"), F.col("business_unit_2_name"), plain_ids
    )
    return rows.withColumn("business_unit_3_name", label)


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def attach_revenue(
    stacked: DataFrame,
    revenue: DataFrame | Lookup,
    keys: list[str],
    period: Literal["month", "year"] = "month",
    default: int | None = None,
    one_a_period: bool = False,
) -> DataFrame:
    """Give every row the revenue (``date``, ``value``, keys) of its period as ``str_value``.

    Revenue given as a DataFrame has one row per period and source (and company) and is
    bounded by the calendar: the 9,999 years a DATE can hold have 119,988 months. It is
    broadcast as it is. Finer revenue comes as a ``Lookup`` and is counted first.

    ``one_a_period``: the revenue DataFrame comes from one aggregation and holds a period once. It
    is grouped by it, so that the planner knows and leaves the join out where nobody reads ``str_value``.
    """
    start = month_start if period == "month" else year_start
    names = {k: f"revenue_{k}" for k in keys}

    def side(df: DataFrame) -> DataFrame:
        return df.select(
            F.col("date").alias("revenue_date"),
            *[F.col(k).alias(n) for k, n in names.items()],
            F.col("value").alias("str_value"),
        )

    on = [(start(F.col("date")), F.col("revenue_date")), *[(F.col(k), F.col(n)) for k, n in names.items()]]
    if isinstance(revenue, Lookup):
        joined = lookup_join(stacked, replace(revenue, df=side(revenue.df)), on)
    elif one_a_period:
        # A struct is never NULL, so here too no extra filter is derived; NULLs inside it are equal.
        known, own = (F.struct(*[pair[n].alias(f"p{k}") for k, pair in enumerate(on)]).alias("__period") for n in (1, 0))
        single = side(revenue).groupBy(known).agg(F.first("str_value").alias("str_value"))
        joined = stacked.withColumn("__period", own).join(F.broadcast(single), "__period", "left").drop("__period")
        joined = joined.withColumn("str_value", F.when(F.col("date").isNotNull(), F.col("str_value")))
    else:
        # Null-safe, so that the planner derives no extra filter for this side: its
        # aggregation stays the one under the subtotal rows and runs once for both.
        same = reduce(lambda a, b: a & b, [left.eqNullSafe(right) for left, right in on])
        joined = stacked.join(F.broadcast(side(revenue)), same, "left")
        joined = joined.withColumn("str_value", F.when(F.col("date").isNotNull(), F.col("str_value")))
    if default is not None:
        joined = joined.withColumn("str_value", F.coalesce(F.col("str_value"), F.lit(default)))
    return joined.drop("revenue_date", *names.values())
