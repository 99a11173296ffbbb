"""Plan-versus-actual steps on hand-made rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from check import rows
from ledgerloom.functions.text import unit_label
from ledgerloom.operators import pnl
from ledgerloom.operators.lookup import Lookup
from ledgerloom.plans import entities as e
from ledgerloom.plans.star import Star
from querybook.fixtures import CODES

D = dt.date
SPECS = e.entities(CODES)


def ledger(spark, data):
    schema = "source string, date date, value decimal(18,2), value_type string, expense_type_5_id long"
    return spark.createDataFrame([(s, d, Decimal(v), t, k) for s, d, v, t, k in data], schema)


@pytest.fixture(scope="module")
def sample(spark):
    return ledger(
        spark,
        [
            ("actual", D(2024, 1, 5), 100, "r", 18),
            ("actual", D(2024, 1, 9), 7, "r", 19),
            ("actual", D(2024, 1, 20), 30, "e", 4),
            ("actual", D(2024, 1, 21), 5, "e", None),
            ("actual", D(2024, 2, 3), 11, "e", 4),
            # March is missing
            ("actual", D(2024, 4, 3), 50, "r", 18),
            ("planning", D(2024, 2, 3), 9, "e", None),
            ("actual", None, 3, "r", 18),
        ],
    )


def by_key(df):
    return {(r["source"], r["value_type"], r["date"]): r for r in df.collect()}


def test_month_sums(sample):
    got = {k: r["value"] for k, r in by_key(pnl.period_sums(sample, ["source"], pnl.monthly_kinds())).items()}
    jan, feb, apr = D(2024, 1, 1), D(2024, 2, 1), D(2024, 4, 1)
    assert got == {
        ("actual", "p", jan): 130,  # neither other income nor the unknown type
        ("actual", "np", jan): 142,
        ("actual", "str", jan): 100,
        ("actual", "p", feb): 11,
        ("actual", "np", feb): 11,  # no revenue row: the subtotal is absent, not NULL
        ("actual", "p", apr): 50,
        ("actual", "np", apr): 50,
        ("actual", "str", apr): 50,
        ("planning", "np", feb): 9,
        ("actual", "p", None): 3,
        ("actual", "np", None): 3,
        ("actual", "str", None): 3,
    }


def test_previous_month_skips_gaps(sample):
    sums = pnl.period_sums(sample, ["source"], pnl.monthly_kinds())
    got = {k: r["previous_value"] for k, r in by_key(pnl.with_previous(sums, ["source"], 1)).items()}
    assert got[("actual", "np", D(2024, 2, 1))] == 142
    assert got[("actual", "np", D(2024, 4, 1))] is None  # March is a gap
    assert got[("actual", "str", D(2024, 4, 1))] is None
    assert got[("actual", "np", None)] is None
    assert got[("planning", "np", D(2024, 2, 1))] is None


def test_net_profit_is_profit_and_other_income(spark):
    """np = p + type 19 when every type is known."""
    data = ledger(spark, [("actual", D(2024, m, 2), m * k, "r", k) for m in range(1, 7) for k in (3, 18, 19)])
    sums = by_key(pnl.period_sums(data, ["source"], pnl.monthly_kinds()))
    for m in range(1, 7):
        month = D(2024, m, 1)
        assert sums[("actual", "np", month)]["value"] == sums[("actual", "p", month)]["value"] + m * 19


def test_consolidated_profit_takes_all_types(sample):
    got = by_key(pnl.period_sums(sample, ["source"], pnl.consolidated_kinds()))
    assert got[("actual", "p", D(2024, 1, 1))]["value"] == 142
    assert ("actual", "np", D(2024, 1, 1)) not in got


def test_signed_year_sums(sample):
    keys = ["source"]
    months = pnl.period_sums(sample, keys, pnl.monthly_kinds(), signed=("p", "np"))
    got = by_key(pnl.rollup_year(months, keys, ("p", "np")))
    assert got[("actual", "p", D(2024, 1, 1))]["value"] == 100 - 30 - 11 + 50
    assert got[("actual", "np", D(2024, 1, 1))]["value"] == 107 - 35 - 11 + 50
    assert got[("actual", "str", D(2024, 4, 1))]["value"] == 50


def test_planned_cost_changes_sign(spark):
    data = ledger(
        spark,
        [
            ("planning", D(2024, 1, 1), 1, "e", 4),
            ("planning", D(2024, 1, 1), 2, "e", None),
            ("planning", D(2024, 1, 1), 4, "r", 18),
            ("actual", D(2024, 1, 1), 8, "e", 4),
        ],
    )
    value = pnl.flip_planned_cost(F.col("value"), F.col("expense_type_5_id"), F.col("source"))
    assert sorted(r[0] for r in data.select(value).collect()) == [-1, 2, 4, 8]


def test_unit_label(spark):
    df = spark.createDataFrame(
        [("A", 0, "x"), ("A", 1, "x"), ("A", 2, "x"), ("A", None, "x"), ("A", 1, None)], "a string, id int, b string"
    )
    columns = (F.col("a"), F.col("id"), F.col("b"))
    got = df.select(unit_label(*columns), unit_label(*columns, (0, 2))).collect()
    assert [tuple(r) for r in got] == [("A", "A"), ("A-x", "A-x"), ("A-x", "A"), ("A", "A"), (None, None)]


def test_attach_revenue(spark, sample):
    sums = pnl.period_sums(sample, ["source"], pnl.monthly_kinds())
    revenue = sums.filter("value_type = 'str'")
    got = pnl.attach_revenue(sample, revenue, ["source"]).collect()
    assert {r["date"]: r["str_value"] for r in got if r["source"] == "actual"} == {
        D(2024, 1, 5): 100,
        D(2024, 1, 9): 100,
        D(2024, 1, 20): 100,
        D(2024, 1, 21): 100,
        D(2024, 2, 3): None,
        D(2024, 4, 3): 50,
        None: None,
    }
    zero = pnl.attach_revenue(sample, revenue, ["source"], default=0).filter("date = '2024-02-03'").collect()
    assert [r["str_value"] for r in zero] == [0, 0]
    # By year start among months, only January's revenue is found.
    yearly = pnl.attach_revenue(sample, Lookup(revenue), ["source"], "year").filter("date is not null").collect()
    assert {r["str_value"] for r in yearly if r["source"] == "actual"} == {100}


def test_all_details_are_the_datasets_details(inputs):
    together = e.all_details(SPECS, inputs.tables, inputs.star)
    apart = None
    for name, spec in SPECS.items():
        part = e.pnl_rows(spec, inputs.tables, inputs.star).select(F.lit(name).alias("entity"), *e.DETAIL_COLUMNS)
        apart = part if apart is None else apart.unionByName(part)
    assert rows(together.columns, together.collect()) == rows(apart.columns, apart.collect())


def test_plan_reads_each_ledger_twice(inputs):
    """Once for the detail rows, once for subtotals and revenue together; no row is shuffled by a join."""
    df = e.plan_actual(SPECS["vietnam"], inputs.tables, inputs.star)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    ledgers = 6  # four own ledgers, two of shared detail
    assert sum("FileScan parquet [l_orderkey" in line for line in plan.split("\n")) == 2 * ledgers
    assert "ReusedExchange" in plan
    for wrong in ("SortMergeJoin", "CartesianProduct", "NestedLoop"):
        assert wrong not in plan


def test_by_department_yearly_revenue(inputs):
    spec = SPECS["group"]
    fixed = e.plan_actual(spec, inputs.tables, inputs.star, yearly_revenue=True)
    quirk = e.plan_actual(spec, inputs.tables, inputs.star)
    assert fixed.columns == quirk.columns
    assert fixed.filter("str_value is not null").count() >= quirk.filter("str_value is not null").count()


@pytest.mark.parametrize("name", ["vietnam", "korea"])
def test_large_dimensions_give_the_same_dataset(inputs, name):
    """Shuffled lookups with hot keys apart, subtotals from month sums."""
    star = Star(
        Lookup(inputs.star.expense.df, broadcast_bytes=20),
        Lookup(inputs.star.department.df, broadcast_bytes=20),
    )
    assert not star.is_small
    small = e.plan_actual(SPECS[name], inputs.tables, inputs.star)
    large = e.plan_actual(SPECS[name], inputs.tables, star)
    assert rows(large.columns, large.collect()) == rows(small.columns, small.collect())
