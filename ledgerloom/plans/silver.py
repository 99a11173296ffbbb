"""The conformed layer: one spec per table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom.operators.conform import DimSpec, FactSpec, Text, conform_dim, conform_fact

LEDGER = FactSpec()
LEDGER_GL = FactSpec(texts=(Text("general_ledger_code"),))
LEDGER_GL_EMPTY = FactSpec(texts=(Text("general_ledger_code", default=""),))
LEDGER_ONE_MEASURE = FactSpec(measures=("financial_report_value",))
# Fixed value: an expense code two companies keep out of their ledgers.
NO_90C = {"expense_code": ("90C",)}
LEDGER_NO_90C = FactSpec(excluded=NO_90C)
LEDGER_COURSE = FactSpec(
    texts=(
        Text("course", "default"),
        Text("cost_by_class", "default"),
        # The output name lacks its last letter; reports read it as it is.
        Text("general_ledger_code", "default", alias="general_ledger_cod"),
    ),
    excluded=NO_90C,
)
ELIMINATION = FactSpec(measures=("management_report_value",), texts=(Text("type"),))
EXCHANGE_RATE = FactSpec(measures=("rate_value",), keys=("department_code",))
PEER = FactSpec(measures=("value",), date="date")

FACTS: dict[str, FactSpec] = {
    # direct ledgers of the consolidation, in millions
    "cloud_ledger": LEDGER,
    "cloud_ledger_planning": LEDGER,
    "partner_ledger": LEDGER,
    "partner_ledger_planning": LEDGER,
    "elimination": ELIMINATION,
    "elimination_planning": ELIMINATION,
    "exchange_rate": EXCHANGE_RATE,
    "exchange_rate_planning": EXCHANGE_RATE,
    "peer_fact": PEER,
    # education
    "education_ledger": LEDGER_COURSE,
    "education_ledger_planning": LEDGER_NO_90C,
    # overseas IT services
    "it_services_ledger": LEDGER_GL,
    "it_services_ledger_planning": LEDGER,
    "it_services_revenue_planning": LEDGER,
    "it_services_exclusion": LEDGER,
    "it_services_overseas_ledger": LEDGER_GL,
    # shared detail of the solutions block, in millions
    "solutions_detail": LEDGER,
    "solutions_detail_planning": LEDGER,
    # training
    "training_ledger": LEDGER_GL,
    "training_ledger_planning": LEDGER,
    "training_adjustment": LEDGER_GL,
    # Japan
    "japan_ledger": LEDGER_ONE_MEASURE,
    "japan_ledger_planning": LEDGER,
    "japan_adjustment": LEDGER,
    "japan_adjustment_planning": LEDGER,
    "japan_allocation": LEDGER_ONE_MEASURE,
    "japan_revenue_planning": LEDGER,
    # Korea
    "korea_ledger": LEDGER_NO_90C,
    "korea_ledger_planning": LEDGER_NO_90C,
    "korea_adjustment": LEDGER,
    "korea_adjustment_planning": LEDGER,
    "korea_revenue_planning": LEDGER,
    # parent company; its blocks are told apart by department
    "main_ledger": LEDGER_GL_EMPTY,
    "main_ledger_planning": LEDGER_GL_EMPTY,
    "main_adjustment": LEDGER_GL,
    "main_adjustment_planning": LEDGER_GL,
}


def _kept(*names: str) -> tuple[Text, ...]:
    return tuple(Text(n, "keep") for n in names)


DIMS: dict[str, DimSpec] = {
    "dim_department": DimSpec(
        (
            Text("department_code", "key"),
            # Spelt as the source spells it.
            *_kept("deparment_id", "ob_id", "unit_id", "business_unit_1_id"),
            Text("business_unit_1_name"),
            *_kept("business_unit_2_id"),
            Text("business_unit_2_name"),
            *_kept("business_unit_3_id"),
            Text("business_unit_3_name"),
        )
    ),
    "dim_expense_type": DimSpec((Text("expense_code", "key"), *_kept("expense_type_1_id", "expense_type_5_id"))),
    "dim_expense_type_2": DimSpec(
        (*_kept("expense_type_id"), Text("expense_type_name", "default"), Text("expense_type_name_2", "default"))
    ),
    "dim_expense_type_3": DimSpec((Text("expense_type_name", "default"), *_kept("expense_type_id"))),
    "dim_expense_type_4": DimSpec((*_kept("expense_type_id"), Text("expense_type_name", "default"))),
    "dim_expense_type_5": DimSpec((*_kept("expense_type_id"), Text("expense_type_name", "default"))),
    "dim_ob": DimSpec(_kept("ob_id", "ob_code", "ob_type_1_code", "ob_type_2_code", "ob_type_3_code")),
    "dim_revenue": DimSpec((*_kept("revenue_id"), Text("revenue_name", "default"))),
}


def conform(name: str, bronze: DataFrame) -> DataFrame:
    """The conformed table ``name`` from its loaded rows."""
    if name in FACTS:
        return conform_fact(bronze, FACTS[name])
    return conform_dim(bronze, DIMS[name])
