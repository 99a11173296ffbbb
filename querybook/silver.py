"""Conform queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import querybook.sqlsteps  # noqa: F401
from ledgerloom.functions.numbers import zero_default
from ledgerloom.functions.text import default_text, norm_key, norm_text
from ledgerloom.plans.silver import DIMS, FACTS
from querybook.fixtures import Inputs
from querybook.registry import query


@query(
    "slv_norm_key",
    """SELECT ref_id, coalesce(trim(upper(department_code)), ' ') AS department_key,
              coalesce(trim(upper(expense_code)), ' ') AS expense_key FROM {v_ledger_raw}""",
)
def norm_keys(i: Inputs) -> DataFrame:
    return i.view("ledger_raw").select(
        "ref_id",
        norm_key(F.col("department_code")).alias("department_key"),
        norm_key(F.col("expense_code")).alias("expense_key"),
    )


@query(
    "slv_norm_text",
    """SELECT accounting_date, coalesce(trim(general_ledger_code), ' ') AS ledger_code,
              coalesce(trim(general_ledger_code), '') AS ledger_code_or_empty, coalesce(course, ' ') AS course
       FROM {b_education_ledger}""",
)
def norm_texts(i: Inputs) -> DataFrame:
    code = F.col("general_ledger_code")
    return i.loaded("education_ledger").select(
        "accounting_date",
        norm_text(code).alias("ledger_code"),
        norm_text(code, "").alias("ledger_code_or_empty"),
        default_text(F.col("course")).alias("course"),
    )


@query(
    "slv_measure_default",
    """SELECT ref_id, CAST(coalesce(financial_report_value, 0) AS DECIMAL(18,2)) AS financial_report_value,
              CAST(coalesce(management_report_value, 0) AS DECIMAL(18,2)) AS management_report_value FROM {v_ledger_raw}""",
)
def measure_defaults(i: Inputs) -> DataFrame:
    names = ("financial_report_value", "management_report_value")
    return i.view("ledger_raw").select(
        "ref_id", *[zero_default(F.col(n)).cast("decimal(18,2)").alias(n) for n in names]
    )


_LEDGER = """SELECT '{t}' AS dataset, accounting_date, CAST(financial_report_value AS DECIMAL(18,2)) AS financial_report_value,
    CAST(management_report_value AS DECIMAL(18,2)) AS management_report_value, expense_code, department_code FROM {{s_{t}}}"""


def _ledgers(i: Inputs, *names: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            i.tables[n].select(
                F.lit(n).alias("dataset"),
                "accounting_date",
                *[F.col(m).cast("decimal(18,2)").alias(m) for m in FACTS[n].measures],
                "expense_code",
                "department_code",
            )
            for n in names
        ],
    )


@query(
    "slv_ledger_two_measure",
    " UNION ALL ".join(_LEDGER.format(t=t) for t in ("main_ledger", "solutions_detail", "cloud_ledger_planning")),
)
def two_measures(i: Inputs) -> DataFrame:
    return _ledgers(i, "main_ledger", "solutions_detail", "cloud_ledger_planning")


@query(
    "slv_ledger_one_measure",
    """SELECT 'japan_ledger' AS dataset, accounting_date, CAST(financial_report_value AS DECIMAL(18,2)) AS value, expense_code, department_code FROM {s_japan_ledger}
       UNION ALL SELECT 'japan_allocation', accounting_date, CAST(financial_report_value AS DECIMAL(18,2)), expense_code, department_code FROM {s_japan_allocation}
       UNION ALL SELECT 'peer_fact', date, CAST(value AS DECIMAL(18,2)), expense_code, department_code FROM {s_peer_fact}""",
)
def one_measure(i: Inputs) -> DataFrame:
    ledgers = _ledgers(i, "japan_ledger", "japan_allocation").withColumnRenamed("financial_report_value", "value")
    peer = i.tables["peer_fact"].select(
        F.lit("peer_fact").alias("dataset"),
        F.col("date").alias("accounting_date"),
        F.col("value").cast("decimal(18,2)").alias("value"),
        "expense_code",
        "department_code",
    )
    return ledgers.unionByName(peer)


@query(
    "slv_elimination",
    """SELECT accounting_date, CAST(management_report_value AS DECIMAL(18,2)) AS management_report_value, expense_code, department_code, type FROM {s_elimination}
       UNION ALL SELECT accounting_date, CAST(management_report_value AS DECIMAL(18,2)), expense_code, department_code, type FROM {s_elimination_planning}""",
)
def elimination(i: Inputs) -> DataFrame:
    rows = i.tables["elimination"].unionByName(i.tables["elimination_planning"])
    return rows.withColumn("management_report_value", F.col("management_report_value").cast("decimal(18,2)"))


@query(
    "slv_reject_keys",
    """SELECT department_code, expense_code, count(*) AS n FROM {s_main_adjustment} GROUP BY department_code, expense_code""",
)
def reject_keys(i: Inputs) -> DataFrame:
    return i.tables["main_adjustment"].groupBy("department_code", "expense_code").agg(F.count(F.lit(1)).alias("n"))


@query(
    "slv_reject_code",
    """SELECT accounting_date, expense_code, department_code, course, cost_by_class, general_ledger_cod FROM {s_education_ledger}
       UNION ALL SELECT accounting_date, expense_code, department_code, NULL, NULL, NULL FROM {s_korea_ledger}""",
)
def reject_code(i: Inputs) -> DataFrame:
    columns = ("accounting_date", "expense_code", "department_code")
    education = i.tables["education_ledger"].select(*columns, "course", "cost_by_class", "general_ledger_cod")
    return education.unionByName(i.tables["korea_ledger"].select(*columns), allowMissingColumns=True)


@query(
    "slv_rate",
    """SELECT 'actual' AS source, accounting_date, CAST(rate_value AS DECIMAL(18,2)) AS rate_value, department_code FROM {s_exchange_rate}
       UNION ALL SELECT 'planning', accounting_date, CAST(rate_value AS DECIMAL(18,2)), department_code FROM {s_exchange_rate_planning}""",
)
def rates(i: Inputs) -> DataFrame:
    def tagged(name: str, source: str) -> DataFrame:
        return i.tables[name].select(
            F.lit(source).alias("source"),
            "accounting_date",
            F.col("rate_value").cast("decimal(18,2)").alias("rate_value"),
            "department_code",
        )

    return tagged("exchange_rate", "actual").unionByName(tagged("exchange_rate_planning", "planning"))


def _register_dims() -> None:
    @query("slv_dim", "SELECT * FROM {s_dim_department}")
    def department(i: Inputs) -> DataFrame:
        return i.tables["dim_department"]

    for name in DIMS:
        query(f"slv_{name}", f"SELECT * FROM {{s_{name}}}")(lambda i, name=name: i.tables[name])


_register_dims()


def _register_facts() -> None:
    """One query per conformed fact: its rows, with every column."""
    for name in FACTS:
        query(f"slv_fact_{name}", f"SELECT * FROM {{s_{name}}}")(lambda i, name=name: i.tables[name])


_register_facts()
