"""From exported text to a report, every step by the names of catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom.plans.entities import plan_actual
from ledgerloom.plans.silver import conform
from ledgerloom.plans.star import CatalogTables, Star
from ledgerloom.sources import load as load_steps
from ledgerloom.sources import tables as sinks
from ledgerloom.sources.contract import Contract
from ledgerloom.sources.workspace import fresh_folder
from querybook import sqlsteps as s
from querybook.fixtures import Inputs
from querybook.gold import SPECS, money, workspace
from querybook.ingest import export
from querybook.registry import query, with_ctes

FACT_TABLES = ("education_ledger", "education_ledger_planning")
DIM_TABLES = ("dim_ob", "dim_department", "dim_expense_type", "dim_expense_type_5")
_DECLARED = {"date": "timestamp", "string": "varchar"}


def declared(i: Inputs, name: str, time_column: str | None) -> Contract:
    """The contract sheet of a table as it is loaded: its columns under their own names."""
    cells = [(1, None, name, None), (2, None, time_column, None)]
    columns = enumerate(i.loaded(name).dtypes, start=7)
    cells += [(row, column, column, _DECLARED.get(kind, kind)) for row, (column, kind) in columns]
    return Contract.from_cells(i.spark.createDataFrame(cells, "row int, a string, b string, c string"))


def to_bronze(i: Inputs, schema: str, name: str, time_column: str | None) -> DataFrame:
    """Export, read back as text, load by contract; facts a year at a time."""
    folder = fresh_folder(i.spark)
    export(i.loaded(name), folder)
    contract, text = declared(i, name, time_column), load_steps.read_text_table(i.spark, folder)
    table = sinks.ensure_table(i.spark, schema, contract, by_year=time_column is not None)
    if time_column is None:
        sinks.replace_all(load_steps.load(text, contract, "dim"), table)
        return i.spark.table(table)
    sinks.replace_years(load_steps.load(text, contract, "fact"), table, time_column)
    return i.spark.table(table).drop(sinks.YEAR_COLUMN)


# Loading makes blank keys NULL, which then count as missing keys.
_BLANK = "CASE WHEN trim(department_code) <> '' THEN department_code END AS department_code"
_MEASURES = "SELECT accounting_date, financial_report_value, management_report_value,"
_SQL = with_ctes(s.attached("education")).replace(f"{_MEASURES} department_code,", f"{_MEASURES} {_BLANK},")


@query("e2e_education", _SQL)
def education(i: Inputs) -> DataFrame:
    bronze, silver = workspace(i), workspace(i)
    for name in DIM_TABLES:
        sinks.materialise(conform(name, to_bronze(i, bronze, name, None)), f"{silver}.{name}")
    for name in FACT_TABLES:
        sinks.materialise(conform(name, to_bronze(i, bronze, name, "accounting_date")), f"{silver}.{name}")
    tables = CatalogTables(i.spark, silver)
    return money(plan_actual(SPECS["education"], tables, Star.of(tables)))
