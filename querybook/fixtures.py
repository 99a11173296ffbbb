"""The engine's input tables, derived from the test tables.

Every view is one SELECT that Spark and DuckDB both run; ``{name}`` stands for a test
table or an earlier view. ``loaded`` gives the engine's input tables built on them.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans.entities import Codes
from ledgerloom.plans.silver import conform
from ledgerloom.plans.star import Star
from ledgerloom.plans.step_down import AllocationCodes, Service, StepDown
from ledgerloom.sources.workspace import materialised

VIEWS = {
    "dim_ob": """
        SELECT r_regionkey AS ob_id,
               CASE r_regionkey WHEN 0 THEN 'VN' WHEN 1 THEN 'SNP' WHEN 2 THEN 'APAC' WHEN 3 THEN 'GROUP' ELSE 'REG' END AS ob_code
        FROM {region}""",
    "dim_department": """
        SELECT s_suppkey AS department_id,
               'DEP-' || CAST(s_suppkey AS VARCHAR(20)) AS department_code,
               CASE WHEN s_suppkey % 15 IN (1,2,3,5,7,11,13,14) THEN 0 ELSE n_regionkey END AS ob_id,
               s_suppkey % 15 AS unit_id,
               n_regionkey AS business_unit_1_id, r_name AS business_unit_1_name,
               s_nationkey % 3 AS business_unit_2_id, n_name AS business_unit_2_name
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "dim_expense_type": """
        SELECT 'EXP-' || CAST(p_partkey AS VARCHAR(20)) AS expense_code,
               CASE WHEN p_partkey % 50 = 49 THEN NULL WHEN p_partkey % 10 < 3 THEN 18
                    WHEN p_partkey % 10 = 3 THEN 19 ELSE p_partkey % 17 + 1 END AS expense_type_5_id,
               CASE WHEN p_partkey % 10 > 3 THEN 'EXPENSE' ELSE 'REVENUE' END AS fee_type_3
        FROM {part}""",
    "dim_expense_type_5": """
        SELECT DISTINCT expense_type_5_id AS expense_type_id,
               'TYPE-' || CAST(expense_type_5_id AS VARCHAR(20)) AS expense_type_name
        FROM {dim_expense_type} WHERE expense_type_5_id IS NOT NULL""",
    "ledger_raw": """
        SELECT CAST(l_shipdate AS DATE) AS accounting_date,
               CASE WHEN l_orderkey % 73 = 0 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS financial_report_value,
               CASE WHEN l_orderkey % 79 = 0 THEN NULL WHEN l_orderkey % 73 = 0 THEN 0
                    ELSE CAST(l_extendedprice - l_tax * 1000 AS DECIMAL(18,2)) END AS management_report_value,
               CASE WHEN l_orderkey % 97 = 0 THEN '0' WHEN l_orderkey % 89 = 0 THEN NULL
                    WHEN l_orderkey % 83 = 0 THEN '   '
                    ELSE ' dep-' || CAST(l_suppkey AS VARCHAR(20)) || ' ' END AS department_code,
               CASE WHEN l_orderkey % 101 = 0 THEN '0' WHEN l_orderkey % 103 = 0 THEN '90C'
                    ELSE 'exp-' || CAST(l_partkey AS VARCHAR(20)) END AS expense_code,
               CASE WHEN l_linestatus = 'F' THEN 'actual' ELSE 'planning' END AS source,
               CASE l_returnflag WHEN 'A' THEN 'ledger' WHEN 'R' THEN 'adjustment' ELSE 'detail' END AS branch,
               l_orderkey AS ref_id
        FROM {lineitem}""",
    "exchange_rate": """
        SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS accounting_date,
               CAST(0.5 + (extract(month FROM l_shipdate) % 5) * 0.25 AS DECIMAL(18,2)) AS rate_value,
               CASE WHEN l_linestatus = 'F' THEN 'actual' ELSE 'planning' END AS source,
               'DEP-2' AS department_code
        FROM {lineitem} WHERE extract(month FROM l_shipdate) % 2 = 0""",
    "elimination": """
        SELECT CAST(o_orderdate AS DATE) AS accounting_date,
               CAST(CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE -o_totalprice / 1000000 END AS DECIMAL(18,2)) AS management_report_value,
               'exp-' || CAST(o_orderkey % 40 AS VARCHAR(20)) AS expense_code,
               'dep-' || CAST(o_orderkey % 20 AS VARCHAR(20)) AS department_code,
               CASE o_orderkey % 3 WHEN 0 THEN ' ELIM-OUTSOURCING ' WHEN 1 THEN 'ELIM-IT' ELSE 'ELIM-GROUP' END AS type,
               CASE WHEN o_orderstatus = 'F' THEN 'actual' ELSE 'planning' END AS source
        FROM {orders} WHERE o_orderkey % 5 = 0""",
    "peer_fact": """
        SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_totalprice / 1000000 AS DECIMAL(18,2)) AS value,
               'exp-' || CAST(o_orderkey % 40 AS VARCHAR(20)) AS expense_code,
               'dep-' || CAST(o_orderkey % 20 AS VARCHAR(20)) AS department_code
        FROM {orders} WHERE o_orderkey % 5 = 1""",
    "man_month": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS accounting_date,
               CASE WHEN o_orderstatus = 'P' THEN 'MM002' ELSE 'MM001' END AS type_id,
               'dep-' || CAST(o_orderkey % 20 AS VARCHAR(20)) AS department_id,
               CAST(o_totalprice / 100000 AS DECIMAL(18,2)) AS value
        FROM {orders}""",
    "effort": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS accounting_date,
               'DEP-' || CAST(o_orderkey % 20 AS VARCHAR(20)) AS department_id,
               CAST(o_totalprice / 1000000 AS DECIMAL(18,2)) AS effort
        FROM {orders} WHERE o_orderkey % 7 = 0""",
    "ledger_text": """
        SELECT CAST(o_orderkey AS VARCHAR(20)) AS ref_id,
               CAST(day(o_orderdate) AS VARCHAR(2)) || '/' || CAST(month(o_orderdate) AS VARCHAR(2)) || '/' || CAST(year(o_orderdate) AS VARCHAR(4)) AS date_dmy_mixed,
               CAST(day(o_orderdate) % 15 + 13 AS VARCHAR(2)) || '/' || CAST(month(o_orderdate) AS VARCHAR(2)) || '/' || CAST(year(o_orderdate) AS VARCHAR(4)) AS date_dmy_only,
               CAST(year(o_orderdate) AS VARCHAR(4)) || '-' || CAST(month(o_orderdate) AS VARCHAR(2)) || '-' || CAST(day(o_orderdate) AS VARCHAR(2)) AS date_iso,
               CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(30)) END AS amount,
               CASE WHEN o_orderkey % 13 = 0 THEN '  ' WHEN o_orderkey % 19 = 0 THEN 'nan' WHEN o_orderkey % 23 = 0 THEN 'NaT' ELSE o_orderpriority END AS note
        FROM {orders}""",
}

_EXTRA = """
    CASE WHEN ref_id % 7 = 0 THEN NULL ELSE ' gl-' || CAST(ref_id % 9 AS VARCHAR(20)) || ' ' END AS general_ledger_code,
    CASE WHEN ref_id % 5 = 0 THEN NULL ELSE ' course-' || CAST(ref_id % 4 AS VARCHAR(20)) END AS course,
    CASE WHEN ref_id % 3 = 0 THEN NULL ELSE 'class-' || CAST(ref_id % 6 AS VARCHAR(20)) END AS cost_by_class"""

# Ledgers as (source, branch) slices of ``ledger_raw``.
SLICES = {
    "main_ledger": ("actual", "ledger"),
    "main_ledger_planning": ("planning", "ledger"),
    "main_adjustment": ("actual", "adjustment"),
    "main_adjustment_planning": ("planning", "adjustment"),
    "solutions_detail": ("actual", "detail"),
    "solutions_detail_planning": ("planning", "detail"),
    "education_ledger": ("actual", "ledger"),
    "education_ledger_planning": ("planning", "ledger"),
    "it_services_ledger": ("actual", "ledger"),
    "it_services_exclusion": ("actual", "adjustment"),
    "it_services_overseas_ledger": ("actual", "detail"),
    "it_services_ledger_planning": ("planning", "ledger"),
    "it_services_revenue_planning": ("planning", "adjustment"),
    "training_ledger": ("actual", "ledger"),
    "training_adjustment": ("actual", "adjustment"),
    "training_ledger_planning": ("planning", "ledger"),
    "japan_ledger": ("actual", "ledger"),
    "japan_allocation": ("actual", "detail"),
    "japan_adjustment": ("actual", "adjustment"),
    "japan_ledger_planning": ("planning", "ledger"),
    "japan_adjustment_planning": ("planning", "adjustment"),
    "japan_revenue_planning": ("planning", "detail"),
    "korea_ledger": ("actual", "ledger"),
    "korea_adjustment": ("actual", "adjustment"),
    "korea_ledger_planning": ("planning", "ledger"),
    "korea_adjustment_planning": ("planning", "adjustment"),
    "korea_revenue_planning": ("planning", "detail"),
    "cloud_ledger": ("actual", "detail"),
    "cloud_ledger_planning": ("planning", "detail"),
    "partner_ledger": ("actual", "adjustment"),
    "partner_ledger_planning": ("planning", "adjustment"),
}

LOADED = {
    "dim_ob": "SELECT ob_id, ob_code, 'T' || CAST(ob_id AS VARCHAR(20)) AS ob_type_1_code, CAST(NULL AS VARCHAR(20)) AS ob_type_2_code, CAST(NULL AS VARCHAR(20)) AS ob_type_3_code FROM {dim_ob}",
    "dim_department": "SELECT lower(department_code) || ' ' AS department_code, department_id AS deparment_id, ob_id, unit_id, business_unit_1_id, ' ' || business_unit_1_name AS business_unit_1_name, business_unit_2_id, business_unit_2_name, business_unit_1_id * 10 + business_unit_2_id AS business_unit_3_id, CAST(NULL AS VARCHAR(20)) AS business_unit_3_name FROM {dim_department}",
    "dim_expense_type": "SELECT expense_code, expense_type_5_id % 4 AS expense_type_1_id, expense_type_5_id FROM {dim_expense_type}",
    "dim_expense_type_2": "SELECT expense_type_id, CASE WHEN expense_type_id % 3 = 0 THEN NULL ELSE expense_type_name END AS expense_type_name, CAST(NULL AS VARCHAR(20)) AS expense_type_name_2 FROM {dim_expense_type_5}",
    "dim_expense_type_3": "SELECT expense_type_id, CASE WHEN expense_type_id % 5 = 0 THEN NULL ELSE expense_type_name END AS expense_type_name FROM {dim_expense_type_5}",
    "dim_expense_type_4": "SELECT expense_type_id, expense_type_name FROM {dim_expense_type_5}",
    "dim_expense_type_5": "SELECT expense_type_id, expense_type_name FROM {dim_expense_type_5}",
    "dim_revenue": "SELECT expense_type_id AS revenue_id, CASE WHEN expense_type_id % 2 = 0 THEN NULL ELSE expense_type_name END AS revenue_name FROM {dim_expense_type_5}",
    "dim_feecode": "SELECT lower(expense_code) AS code, CAST(NULL AS VARCHAR(20)) AS fee_type_1, CAST(NULL AS VARCHAR(20)) AS fee_type_2, fee_type_3, CAST(NULL AS VARCHAR(20)) AS fee_type_4, expense_type_5_id AS type_id FROM {dim_expense_type}",
    "elimination": "SELECT accounting_date, management_report_value, expense_code, department_code, type FROM {elimination} WHERE source = 'actual'",
    "elimination_planning": "SELECT accounting_date, management_report_value, expense_code, department_code, type FROM {elimination} WHERE source = 'planning'",
    "exchange_rate": "SELECT accounting_date, rate_value, department_code FROM {exchange_rate} WHERE source = 'actual'",
    "exchange_rate_planning": "SELECT accounting_date, rate_value, department_code FROM {exchange_rate} WHERE source = 'planning'",
    "peer_fact": "SELECT date, value, expense_code, department_code FROM {peer_fact}",
    "man_month": "SELECT accounting_date, value, type_id, department_id FROM {man_month}",
    "effort": "SELECT accounting_date, effort, department_id FROM {effort}",
    **{
        name: f"SELECT CAST(date_trunc('month', accounting_date) AS DATE) AS accounting_date, financial_report_value AS bctc, management_report_value AS bcqt, expense_code AS fee_code, TRIM(department_code) AS department_id, 'gl3-' || CAST(ref_id % 8 AS VARCHAR(20)) AS gl3_code FROM {{ledger_raw}} WHERE branch = '{branch}'"
        for name, branch in (("allocation_ledger", "ledger"), ("allocation_adjustment", "adjustment"))
    },
    **{
        name: f"SELECT accounting_date, financial_report_value, management_report_value, department_code, expense_code, {_EXTRA} FROM {{ledger_raw}} WHERE source = '{source}' AND branch = '{branch}'"
        for name, (source, branch) in SLICES.items()
    },
}

CODES = Codes(
    apac_block="APAC",
    solutions_block="SNP",
    vietnam_block="VN",
    group_block="GROUP",
    regional_block="REG",
    japan_department="DEP-2",
    japan_takeover_year=1996,
    japan_allocation_department="DEP-5",
    korea_department="DEP-2",
    shared_detail_department="DEP-7",
    outsourcing_elimination="ELIM-OUTSOURCING",
    it_elimination="ELIM-IT",
    group_elimination="ELIM-GROUP",
    company="OWN",
    peer_company="PEER",
)

ALLOCATION_CODES = AllocationCodes(
    comtor=Service("DEP-1", "effort", fold_case=True),
    qa=Service("dep-2", "effort", fold_case=False),
    base_excluded=("dep-3", "dep-4"),
    overhead_excluded=("DEP-3", "DEP-4"),
    base_blocks=("VN", "SNP"),
    block="VN",
    expense_class="EXPENSE",
)


#: Views that a query over many ledgers stores first, with their partitions.
_LAYOUT = {"ledger_raw": ("source", "branch"), "exchange_rate": ("source",)}


class _Conformed(dict):
    """Conformed tables by name; tables the allocation reads unconformed stay as loaded."""

    def __init__(self, inputs: "Inputs"):
        super().__init__()
        self.inputs = inputs

    def __missing__(self, name: str) -> DataFrame:
        loaded = self.inputs.loaded(name)
        raw = ("dim_feecode", "allocation_ledger", "allocation_adjustment", "man_month", "effort")
        self[name] = loaded if name in raw else conform(name, loaded)
        return self[name]


class Inputs:
    """The inputs of one query run.

    ``stored``: the raw ledger is derived once and written by source and branch, so that each
    ledger is a few folders of its own, as tables in a warehouse are. Without it every ledger
    is derived from the test table again, which costs less for one or two of them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, stored: bool = False):
        self.spark, self.sf_dir, self.stored = spark, sf_dir, stored
        self._opened: dict[str, DataFrame] = {}

    def _select(self, sql: str) -> DataFrame:
        return self.spark.sql(sql, **{n: self.view(n) for n in set(re.findall(r"\{(\w+)\}", sql))})

    def view(self, name: str) -> DataFrame:
        if name not in self._opened:
            if name in VIEWS:
                view = self._select(VIEWS[name])
                layout = _LAYOUT.get(name) if self.stored else None
                self._opened[name] = view if layout is None else materialised(view, *layout)
            else:
                self._opened[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._opened[name]

    def loaded(self, name: str) -> DataFrame:
        return self._select(LOADED[name])

    @cached_property
    def tables(self) -> _Conformed:
        return _Conformed(self)

    @cached_property
    def star(self) -> Star:
        return Star.of(self.tables)

    @cached_property
    def step_down(self) -> StepDown:
        return StepDown(self.tables, ALLOCATION_CODES)
