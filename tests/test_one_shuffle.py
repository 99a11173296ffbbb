"""Where only the expense dimension is too large to broadcast, facts are shuffled once and narrow."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from check import rows
from ledgerloom.operators import pnl
from ledgerloom.operators.lookup import Lookup
from ledgerloom.plans import consolidated as c
from ledgerloom.plans import entities as e
from ledgerloom.plans.star import Star
from ledgerloom.sources.workspace import materialised
from querybook.fixtures import CODES

SPECS = e.entities(CODES)


@pytest.fixture
def star(spark):
    """Codes in two spellings, a department without a block; the expense dimension is large."""
    expense = spark.createDataFrame(
        [("e-1", 18, "income"), ("E-2", 4, "cost"), ("E-3", None, None), ("E-4", 19, "other")],
        "expense_code string, expense_type_5_id int, expense_type_5_name string",
    )
    names = [("D-1", 1, "one", 0, "u", 10, "VN"), ("d-2", 2, "two", 1, "v", 11, "SNP"), ("D-3", 3, "three", None, None, None, None)]
    department = spark.createDataFrame(
        names,
        "department_code string, business_unit_1_id int, business_unit_1_name string, business_unit_2_id int, "
        "business_unit_2_name string, business_unit_3_id int, ob_code string",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Star(Lookup(expense, broadcast_bytes=0), Lookup(department))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def small(star):
    return Star(Lookup(star.expense.df), star.department)


@pytest.fixture
def ledger(spark, tmp_path):
    n = F.col("id")
    codes = [F.when(n % k == 0, F.lit(None)).otherwise(F.concat(F.lit(p), (n % m).cast("string"))) for k, p, m in ((11, "e-", 6), (13, "d-", 5))]
    # read from files, so that a plan shows how often it is read
    path = str(tmp_path / "ledger")
    spark.range(400).select(
        F.date_add(F.lit("2023-01-01"), (n * 7 % 700).cast("int")).alias("accounting_date"),
        (n % 50 - 5).cast("decimal(18,2)").alias("financial_report_value"),
        (n % 60 - 5).cast("decimal(18,2)").alias("management_report_value"),
        codes[0].alias("expense_code"),
        codes[1].alias("department_code"),
        F.lit(CODES.it_elimination).alias("type"),
    ).write.parquet(path)
    return spark.read.parquet(path)


class Ledgers(dict):
    """The same rows for every ledger."""

    def __init__(self, ledger):
        super().__init__()
        self.ledger = ledger

    def __missing__(self, name):
        if name == "peer_fact":
            return self.ledger.selectExpr("accounting_date AS date", "management_report_value AS value", "expense_code", "department_code")
        if name.startswith("exchange_rate"):
            return self.ledger.selectExpr("trunc(accounting_date, 'MM') AS accounting_date", "CAST(2 AS decimal(18,2)) AS rate_value", "'DEP-2' AS department_code").distinct()
        return self.ledger


def executed(df):
    got = rows(df.columns, df.collect())
    return got, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffles(plan):
    """Shuffles of facts for a join with the expense dimension, the dimension's own included."""
    return len(re.findall(r"- Exchange hashpartitioning\(__key_0", plan))


@pytest.mark.parametrize("block", [None, "VN"])
def test_attributes_of_departments_are_not_shuffled(star, ledger, block):
    fact = ledger.withColumnsRenamed({"accounting_date": "date", "management_report_value": "value"})
    fact = fact.select("date", "value", "expense_code", "department_code")
    expected = pnl.enrich(fact, small(star).expense, star.department, "upper", block)
    got = pnl.enrich(fact, star.expense, star.department, "upper", block)
    assert got.columns == expected.columns
    result, plan = executed(got)
    assert result == executed(expected)[0] and shuffles(plan) == 2
    # departments are joined above the shuffled join, and without their attributes below it
    assert plan.index("BroadcastHashJoin") < plan.index("ShuffledHashJoin")
    below = plan[plan.index("ShuffledHashJoin") :]
    assert ("LeftSemi" in below) == (block is not None) and below.count("BroadcastHashJoin") == (block is not None)
    assert "SortMergeJoin" not in plan


def test_a_hash_table_too_large_for_a_task_is_sorted(star, ledger):
    fact = ledger.selectExpr("accounting_date AS date", "management_report_value AS value", "expense_code", "department_code")
    huge = replace(star.expense, _bytes=1 << 40)
    result, plan = executed(pnl.enrich(fact, huge, star.department))
    assert result == executed(pnl.enrich(fact, star.expense, star.department))[0]
    assert "SortMergeJoin" in plan


def test_details_and_sums_of_the_consolidation_read_one_shuffle(star, ledger):
    tables = Ledgers(ledger)
    result, plan = executed(c.consolidated(CODES, tables, star))
    assert result == executed(c.consolidated(CODES, tables, small(star)))[0]
    assert shuffles(plan) == 3 and "ReusedExchange" in plan  # the facts; the dimension with and without names


def test_details_and_sums_of_given_details_read_one_shuffle(star, ledger):
    tables = Ledgers(ledger)
    details = materialised(e.all_details(SPECS, tables, small(star)))
    result, plan = executed(c.consolidate(CODES, details, tables, star))
    assert result == executed(c.consolidate(CODES, details, tables, small(star)))[0]
    assert shuffles(plan) == 3 and "ReusedExchange" in plan


def test_rows_with_their_dimensions_are_not_joined_again(star, ledger):
    tables = Ledgers(ledger)
    joined, bare = e.all_rows(SPECS, tables, star), e.all_details(SPECS, tables, star)
    once, twice = (c.consolidated_rows(CODES, d, tables, star) for d in (joined, bare))
    assert sorted(once.columns) == sorted(twice.columns)
    assert dict(once.dtypes) == dict(twice.dtypes)
    out = c.stacked(once, pnl.with_previous(c.month_sums(once), c.KEYS, 1))
    result, plan = executed(out)
    # the entities' facts, all others, and the dimension with the columns that either needs
    assert shuffles(plan) <= 4
    twice = twice.select(*once.columns)
    assert result == executed(c.stacked(twice, pnl.with_previous(c.month_sums(twice), c.KEYS, 1)))[0]


def test_a_code_twice_doubles_rows_twice(star, ledger):
    twice = Lookup(star.expense.df.unionByName(star.expense.df.filter("expense_code = 'E-2'")))
    star, tables = Star(twice, star.department), Ledgers(ledger)
    joined, bare = (c.consolidated_rows(CODES, f(SPECS, tables, star), tables, star) for f in (e.all_rows, e.all_details))
    assert rows(joined.columns, joined.collect()) == rows(joined.columns, bare.select(*joined.columns).collect())
