"""What a query doesn't read of a report is not computed: revenue, subtotals, joins of rows with a date."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import pnl
from ledgerloom.plans import checks

D = dt.date


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def facts(spark):
    rows = [
        ("actual", D(2024, 1, 5), Decimal(100), "r", 18),
        ("actual", D(2024, 1, 20), Decimal(30), "e", 4),
        ("actual", D(2024, 2, 3), Decimal(11), "e", None),
        ("planning", D(2024, 1, 9), Decimal(9), "r", 18),
        ("planning", None, Decimal(3), "r", 18),
        (None, D(2024, 1, 7), Decimal(5), "r", 18),
    ]
    return spark.createDataFrame(rows, "source string, date date, value decimal(18,2), value_type string, expense_type_5_id long")


def report(rows):
    sums = pnl.with_previous(pnl.period_sums(rows, ["source"], pnl.monthly_kinds()), ["source"], 1)
    revenue = sums.filter(F.col("value_type") == pnl.TOTAL_REVENUE)
    return pnl.attach_revenue(pnl.stack_rows(rows, sums, ()), revenue, ["source"], one_a_period=True)


def test_details_of_a_report_need_no_subtotals(facts):
    details = report(facts).filter(F.col("value_type").isin(*pnl.DETAIL_TYPES)).select("source", "date", "value", "value_type")
    assert "Aggregate" not in plan(details) and "Join" not in plan(details)
    key = str
    assert sorted(map(tuple, details.collect()), key=key) == sorted((tuple(r)[:4] for r in facts.collect()), key=key)


def test_revenue_grouped_by_period_is_the_same_revenue(facts):
    sums = pnl.period_sums(facts, ["source"], pnl.monthly_kinds())
    revenue = sums.filter(F.col("value_type") == pnl.TOTAL_REVENUE)
    plain, grouped = (
        sorted(map(tuple, pnl.attach_revenue(facts, revenue, ["source"], one_a_period=g).select("source", "date", "value", "str_value").collect()), key=str)
        for g in (False, True)
    )
    assert plain == grouped
    assert [r[3] for r in grouped if r[0] == "actual" and r[1].month == 1] == [100, 100]
    assert [r[3] for r in grouped if r[0] is None] == [5] and [r[3] for r in grouped if r[1] is None] == [None]


def test_missing_dates_are_filtered_before_joins_and_sums(spark, facts):
    kinds = spark.createDataFrame([(18, "income"), (18, "twice"), (4, "cost")], "expense_type_5_id long, name string")
    joined = facts.join(F.broadcast(kinds), "expense_type_5_id", "left")
    found = checks.null_counts({"facts": (joined, "date"), "report": (report(facts), "date"), "none": (facts.filter("date is not null"), "date")})
    assert {r["dataset"]: r["nulls"] for r in found.collect()} == {"facts": 2, "report": 4, "none": 0}
    optimised = plan(checks.null_counts({"facts": (joined, "date")}))
    assert optimised.index("Filter isnull(date") > optimised.index("Join")
