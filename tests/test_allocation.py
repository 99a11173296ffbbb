"""Allocation steps against their definitions."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from check import rows
from ledgerloom.operators import allocation as a
from ledgerloom.plans.step_down import AllocationCodes, Service, StepDown

D = dt.date(2024, 1, 1)
E = dt.date(2024, 2, 1)
N = dt.date(2024, 3, 1)


@pytest.fixture(scope="module")
def base(spark):
    data = [(D, "A", 2), (D, "B", 6), (E, "A", 0), (E, "B", 0), (None, "C", 5), (None, "D", 1)]
    rows = [(d, x, Decimal(v)) for d, x, v in data]
    return spark.createDataFrame(rows, "date date, department_code string, value decimal(18,2)")


@pytest.fixture(scope="module")
def pool(spark):
    data = [(D, "P", 80), (D, "Q", 8), (E, "P", 7), (N, "P", 9), (None, "P", 3)]
    rows = [(d, x, Decimal(v)) for d, x, v in data]
    return spark.createDataFrame(rows, "date date, giver string, expense decimal(18,2)")


def test_total_equals_the_window(base):
    where = F.col("department_code") != "B"
    window = Window.partitionBy("date")
    expected = base.select(
        "*", F.sum("value").over(window).alias("t"), F.sum(F.when(where, F.col("value"))).over(window).alias("u")
    )
    got = a.with_total(a.with_total(base, "value", "t"), "value", "u", where)
    assert rows(got.columns, got.collect()) == rows(expected.columns, expected.collect())


def test_full_allocation_equals_the_full_join(base, pool):
    p = pool.withColumnRenamed("date", "pool_date")
    expected = base.join(p, base.date == p.pool_date, "full").drop("pool_date")
    got = a.allocate_full(base, pool)
    assert rows(got.columns, got.collect()) == rows(expected.columns, expected.collect())


def test_shares_sum_to_the_pool(base, pool):
    totals = a.with_total(base, "value", "total")
    shared = a.allocate_full(totals, pool).select(
        "date", "giver", a.share(F.col("value"), F.col("expense"), F.col("total")).alias("d")
    )
    sums = {(r["date"], r["giver"]): r["d"] for r in shared.groupBy("date", "giver").agg(F.sum("d").alias("d")).collect()}
    assert sums[(D, "P")] == pytest.approx(80) and sums[(D, "Q")] == pytest.approx(8)
    assert sums[(E, "P")] is None  # a zero total allocates nothing
    assert sums[(None, "P")] is None  # cost of a month without base rows


def effort_rows(spark, data):
    rows = [(D, x, *(None if v is None else Decimal(v) for v in rest)) for x, *rest in data]
    schema = "date date, department_code string, effort decimal(18,2), expense_value decimal(18,2), man_month_value decimal(18,2)"
    return spark.createDataFrame(rows, schema)


def test_effort_allocation(spark):
    data = effort_rows(spark, [("A", 2, 100, 10), ("A", 1, 100, 10), ("B", 3, 100, 10), ("POOL", 2, 100, 10)])
    got = {r["department_code"]: r for r in a.allocate_effort(data, F.col("department_code") == "POOL").collect()}
    assert {k: (r["value"], r["distribution_regular"]) for k, r in got.items()} == {
        "A": (3.0, pytest.approx(30)),
        "B": (3.0, pytest.approx(30)),
        "POOL": (2.0, pytest.approx(20)),
        "Overhead": (4.0, pytest.approx(40)),  # 10 man-months less the 6 used outside the pool
    }


def test_effort_equals_doubled_rows(spark):
    data = effort_rows(spark, [("A", 2, 100, 10), ("Overhead", 1, 90, None), ("B", 3, None, 10), (None, 2, 100, 12)])
    is_pool = F.col("department_code") == "POOL"
    v = F.when(F.col("department_code") == "Overhead", F.avg("man_month_value") - F.sum("effort")).otherwise(F.sum("effort"))
    expected = (
        a.with_overhead_rows(data, is_pool)
        .groupBy("date", "department_code")
        .agg(F.round(v.cast("double"), 4).alias("value"))
    )
    got = a.allocate_effort(data, is_pool).select("date", "department_code", F.round("value", 4).alias("value"))
    assert rows(got.columns, got.collect()) == rows(expected.columns, expected.collect())


@pytest.fixture(scope="module")
def tables(spark):
    def table(schema, *data):
        return spark.createDataFrame(list(data), schema)

    d = Decimal
    ledger = "accounting_date date, bctc decimal(18,2), bcqt decimal(18,2), fee_code string, department_id string, gl3_code string"
    return {
        "dim_ob": table("ob_id int, ob_code string", (1, "VN"), (2, "SNP")),
        "dim_department": table(
            "department_code string, unit_id int, ob_id int", ("S", 5, 1), ("BO", 7, 1), ("PQM", 14, 1), ("W", 1, 1)
        ),
        "dim_feecode": table(
            "code string, fee_type_1 string, fee_type_2 string, fee_type_3 string, fee_type_4 string, type_id long",
            ("X", None, None, "Chi phí", None, 1),
        ),
        "allocation_ledger": table(
            ledger, (D, d(0), d(8_000_000), "x", "s", None), (D, d(0), d(2_000_000), "x", "pqm", None)
        ),
        "allocation_adjustment": table(ledger, (D, d(0), d(6_000_000), "X", "BO", None)),
        "man_month": table(
            "accounting_date date, value decimal(18,2), type_id string, department_id string",
            (D, d(1), "MM001", "PQM"),
            (D, d(3), "MM001", "W"),
            (D, d(9), "MM002", "W"),
        ),
        "effort": table("accounting_date date, effort decimal(18,2), department_id string", (D, d(1), "W")),
    }


def codes(qa: Service) -> AllocationCodes:
    return AllocationCodes(
        comtor=Service("NONE", "effort", True),
        qa=qa,
        base_excluded=(),
        overhead_excluded=(),
        base_blocks=("VN", "SNP"),
        block="VN",
    )


def test_service_spelling(tables):
    """The case-sensitive service misses its own ledger rows spelt in lower case; man-months match."""
    strict = StepDown(tables, codes(Service("PQM", "effort", False)))
    folded = StepDown(tables, codes(Service("PQM", "effort", True)))
    # support 8 * 1/4 + back office 6 * 1/4, and the service's own 2 only when case is folded
    assert strict.service_pool(strict.codes.qa).collect()[0]["expense_value"] == pytest.approx(3.5)
    assert folded.service_pool(folded.codes.qa).collect()[0]["expense_value"] == pytest.approx(5.5)


def test_pools_of_both_services_come_from_one_table(tables):
    """A department of both services counts in each; one without expense has no pool."""
    both = StepDown(tables, replace(codes(Service("PQM", "effort", True)), comtor=Service("PQM", "effort", True)))
    pools = [both.service_pool(s).collect() for s in both.services]
    assert [[r["expense_value"] for r in p] for p in pools] == [[pytest.approx(5.5)]] * 2
    one = StepDown(tables, codes(Service("PQM", "effort", True)))
    assert one.service_pool(one.codes.comtor).collect() == []
    with pytest.raises(ValueError):
        one.service_pool(Service("W", "effort", True))


def test_a_dataset_of_both_services_distributes_once(tables, monkeypatch):
    built = []
    for name in ("support_received", "bo"):
        step = getattr(StepDown, name)
        monkeypatch.setattr(StepDown, name, lambda self, n=name, f=step: built.append(n) or f(self))
    step = StepDown(tables, codes(Service("PQM", "effort", True)))
    assert [r["department_code"] for r in step.overhead().collect()] == ["W"]  # a service carries none
    assert sorted(built) == ["bo", "support_received"]


def test_received_support_equals_the_pairs(inputs):
    step = inputs.step_down
    pairs = step.support().groupBy("date", "department_code").agg(F.round(F.sum("distribution"), 6).alias("d"))
    sums = step.support_by_department().select("date", "department_code", F.round("distribution", 6).alias("d"))
    assert rows(sums.columns, sums.collect()) == rows(pairs.columns, pairs.collect())


def test_datasets_are_ordered_with_nulls_last(inputs):
    for name, keys in StepDown.ORDER.items():
        got = [tuple(r[k] for k in keys) for r in inputs.step_down.dataset(name).collect()]
        assert got == sorted(got, key=lambda t: tuple((v is None, v) if v is not None else (True,) for v in t))
