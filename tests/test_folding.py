"""Codes are folded once a row, whatever reads them."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import pnl
from ledgerloom.operators.conform import FactSpec, conform_fact
from ledgerloom.operators.lookup import Lookup

LOADED = "accounting_date date, financial_report_value decimal(18,2), management_report_value decimal(18,2), expense_code string, department_code string"
NO_90C = FactSpec(excluded={"expense_code": ("90C",)})


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def ledger(spark):
    codes = [(" exp-1 ", "dep-1"), ("0", "dep-1"), (" 0 ", "dep-1"), (None, "dep-1"), ("exp-1", None), ("   ", "dep-1"), (" 90c", "dep-1"), ("exp-1", " 0")]
    return spark.createDataFrame([(None, None if k else 1, k, *c) for k, c in enumerate(codes)] + [(None, 0, None, "exp-1", "dep-1")], LOADED.replace("decimal(18,2)", "int"))


def test_conformed_codes(ledger):
    kept = [("EXP-1", "DEP-1"), ("", "DEP-1")]
    got = lambda spec: sorted(tuple(r) for r in conform_fact(ledger, spec).select("expense_code", "department_code").collect())
    assert got(NO_90C) == sorted(kept)
    assert got(FactSpec()) == sorted([*kept, ("90C", "DEP-1")])


def test_each_code_is_folded_once(spark, tmp_path):
    spark.range(10).selectExpr("DATE'2024-01-01' AS accounting_date", "1 AS financial_report_value", "1 AS management_report_value", "'exp-1' AS expense_code", "'dep-1' AS department_code").write.parquet(f"{tmp_path}/ledger")
    ledger = spark.read.parquet(f"{tmp_path}/ledger")
    facts = pnl.tag_source(conform_fact(ledger, FactSpec()), conform_fact(ledger, FactSpec()))
    dims = [
        spark.createDataFrame([("EXP-1", 18, "a")], ", ".join(f"{c} string" for c in pnl.EXPENSE_COLUMNS)).localCheckpoint(),
        spark.createDataFrame([("DEP-1",)], "department_code string").select(*[F.lit("DEP-1").alias(c) for c in pnl.DEPARTMENT_COLUMNS]).localCheckpoint(),
    ]
    joined = pnl.enrich(facts, *[Lookup.bounded(d) for d in dims])
    assert joined.filter("expense_type_5_name = 'a' and ob_code = 'DEP-1'").count() == 20
    # no code is folded to be filtered, or once more to be joined
    folded = [line.count("upper(") for line in plan(joined).splitlines() if "trim(" in line or "fact_" in line]
    assert sum(folded) == 4, plan(joined)
