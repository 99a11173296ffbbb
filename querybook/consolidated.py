"""Consolidation queries."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import pnl
from ledgerloom.plans import consolidated as c
from ledgerloom.plans.entities import all_details, all_rows, plan_actual
from ledgerloom.sources.tables import Gate, materialise
from querybook import sqlsteps as s
from querybook.fixtures import CODES, Inputs
from querybook.gold import SPECS, workspace
from querybook.registry import cte
from querybook.registry import query as register

query = partial(register, stored=True)

# Consolidated amounts are in millions and keep six digits.
MILLIONS = "decimal(28,6)"


def millions(df: DataFrame) -> DataFrame:
    names = [n for n in ("value", "previous_value", "str_value") if n in df.columns]
    return df.withColumns({n: F.col(n).cast(MILLIONS) for n in names})


def details_of(i: Inputs) -> DataFrame:
    """The detail rows of all entities; the same rows their datasets hold as 'e' and 'r'."""
    return all_details(SPECS, i.tables, i.star)


def rows_all(i: Inputs) -> DataFrame:
    return c.consolidated_rows(CODES, all_rows(SPECS, i.tables, i.star), i.tables, i.star)


_DETAIL = "date, value, expense_code, department_code, source"
_KEPT = "date, expense_code, department_code, source"
ENTITIES = ("vietnam", "regional", "apac", "solutions", "group", "it_services", "education", "training")

for _n in SPECS:
    cte(f"x_{_n}", f"SELECT {_DETAIL} FROM {{er_{_n}}}")
for _n in ("cloud_ledger", "partner_ledger"):
    cte(
        f"x_{_n}",
        " UNION ALL ".join(
            f"SELECT accounting_date AS date, management_report_value AS value, expense_code, department_code, '{src}' AS source FROM {{s_{t}}}"
            for t, src in ((_n, "actual"), (f"{_n}_planning", "planning"))
        ),
    )
cte(
    "x_elimination",
    " UNION ALL ".join(
        f"SELECT accounting_date AS date, management_report_value AS value, expense_code, department_code, type, '{src}' AS source FROM {{s_{t}}}"
        for t, src in (("elimination", "actual"), ("elimination_planning", "planning"))
    ),
)
cte(
    "x_rate",
    "SELECT accounting_date, rate_value, department_code, 'actual' AS source FROM {s_exchange_rate} "
    "UNION ALL SELECT accounting_date, rate_value, department_code, 'planning' FROM {s_exchange_rate_planning}",
)
for _n in ("japan", "korea"):
    cte(
        f"fx_{_n}",
        f"""SELECT d.date, CASE WHEN r.rate_value IS NULL THEN CAST(d.value AS DECIMAL(28,10))
               ELSE CAST(CAST(d.value AS DECIMAL(28,10)) * CAST(r.rate_value AS DECIMAL(10,6)) AS DECIMAL(28,10)) END AS value,
               d.expense_code, d.department_code, d.source
            FROM {{x_{_n}}} d LEFT JOIN {{x_rate}} r ON r.department_code = 'DEP-2' AND r.source = d.source
             AND date_trunc('month', r.accounting_date) = date_trunc('month', d.date)""",
    )

_MILLIONTH = "CAST(CAST(value AS DECIMAL(28,10)) * CAST(0.000001 AS DECIMAL(10,6)) AS DECIMAL(28,10))"


def _part(segment: str, step: str, scaled: bool, where: str = "TRUE") -> str:
    value = _MILLIONTH if scaled else "CAST(value AS DECIMAL(28,10))"
    return f"SELECT '{segment}' AS segment, date, {value} AS value, expense_code, department_code, source FROM {{{step}}} WHERE {where}"


cte(
    "x_own",
    " UNION ALL ".join(
        [_part("outsourcing", n, True) for n in ("x_vietnam", "x_regional", "fx_japan", "fx_korea", "x_apac", "x_it_services")]
        + [_part("outsourcing", n, False) for n in ("x_cloud_ledger", "x_partner_ledger")]
        + [_part("outsourcing", "x_elimination", False, "type = 'ELIM-OUTSOURCING'")]
        + [_part("it", "x_solutions", True), _part("it", "x_elimination", False, "type = 'ELIM-IT'")]
        + [_part("education", n, True) for n in ("x_education", "x_training")]
        + [_part("group", "x_group", True), _part("group", "x_elimination", False, "type = 'ELIM-GROUP'")]
    ),
)
cte(
    "x_fact",
    f"""SELECT {_DETAIL}, 'OWN' AS company FROM {{x_own}}
        UNION ALL SELECT date, value, expense_code, department_code, 'actual', 'PEER' FROM {{s_peer_fact}}""",
)
cte("er_all", s.enriched("x_fact", extra=", f.company"))
_KEYS = ["source", "company"]
s._sums("all", "er_all", "p", "TRUE", _KEYS, "month", "MONTH")
s._sums("all", "er_all", "str", "expense_type_5_id = 18", _KEYS, "month", "MONTH")
cte(
    "year_revenue_all",
    "SELECT source, company, CAST(date_trunc('year', date) AS DATE) AS date, sum(value) AS value FROM {str0_all} GROUP BY ALL",
)
s.stacked("all", kinds=("p", "str"), company=True)

_SIX = s.money("value", 6)


@query(
    "con_detail_rows",
    " UNION ALL ".join(f"SELECT '{n}' AS entity, {_KEPT}, {_SIX} FROM {{x_{n}}}" for n in ENTITIES),
)
def detail_rows(i: Inputs) -> DataFrame:
    return millions(details_of(i).filter(F.col("entity").isin(*ENTITIES)))


@query(
    "con_report_details",
    " UNION ALL ".join(
        f"SELECT '{n}' AS entity, {_KEPT}, {_SIX} FROM {{erc_{n}}} WHERE value_type IN ('e', 'r')" for n in ENTITIES
    ),
)
def report_details(i: Inputs) -> DataFrame:
    parts = [millions(c.report_details(plan_actual(SPECS[n], i.tables, i.star), n)) for n in ENTITIES]
    return reduce(DataFrame.unionByName, parts)


@query(
    "con_direct_ledgers",
    f"SELECT 'cloud_ledger' AS ledger, {_KEPT}, {_SIX} FROM {{x_cloud_ledger}} UNION ALL SELECT 'partner_ledger', {_KEPT}, {_SIX} FROM {{x_partner_ledger}}",
)
def direct_ledgers(i: Inputs) -> DataFrame:
    cloud, partner = (
        millions(c.direct_ledger(i.tables, n)).withColumn("ledger", F.lit(n)) for n in ("cloud_ledger", "partner_ledger")
    )
    return cloud.unionByName(partner)


@query("con_eliminations", f"SELECT {_KEPT}, type, {_SIX} FROM {{x_elimination}}")
def eliminations(i: Inputs) -> DataFrame:
    return millions(c.eliminations(i.tables))


@query(
    "con_rates",
    "SELECT accounting_date, CAST(rate_value AS DECIMAL(12,6)) AS rate_value, department_code, source FROM {x_rate}",
)
def rates(i: Inputs) -> DataFrame:
    return c.rates(i.tables).withColumn("rate_value", F.col("rate_value").cast("decimal(12,6)"))


@query(
    "con_fx_multiply",
    f"SELECT 'japan' AS entity, {_KEPT}, {_SIX} FROM {{fx_japan}} UNION ALL SELECT 'korea', {_KEPT}, {_SIX} FROM {{fx_korea}}",
)
def fx_multiplied(i: Inputs) -> DataFrame:
    details = details_of(i).filter(F.col("entity").isin("japan", "korea"))
    return millions(c.converted(CODES, details, i.tables))


@query("con_union_scaled", f"SELECT segment, {_KEPT}, {_SIX} FROM {{x_own}}")
def union_scaled(i: Inputs) -> DataFrame:
    return millions(c.union_scaled(CODES, details_of(i), i.tables))


@query(
    "con_elim_routing",
    f"""SELECT CASE type WHEN 'ELIM-OUTSOURCING' THEN 'outsourcing' WHEN 'ELIM-IT' THEN 'it' ELSE 'group' END AS segment,
               {_KEPT}, {_SIX} FROM {{x_elimination}}""",
)
def elimination_routing(i: Inputs) -> DataFrame:
    return millions(c.routed_eliminations(CODES, i.tables))


@query("con_company_tag", "SELECT company, source, count(*) AS n, CAST(sum(value) AS DECIMAL(28,6)) AS value FROM {x_fact} GROUP BY ALL")
def company_tag(i: Inputs) -> DataFrame:
    fact = c.tag_company(c.union_scaled(CODES, details_of(i), i.tables), i.tables["peer_fact"], CODES)
    return millions(fact.groupBy("company", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")))


@query(
    "con_enrich",
    f"SELECT company, value_type, expense_type_5_name, ob_code, business_unit_1_name, {_KEPT}, {_SIX} FROM {{er_all}}",
)
def enriched(i: Inputs) -> DataFrame:
    columns = ("company", "value_type", "expense_type_5_name", "ob_code", "business_unit_1_name")
    return millions(rows_all(i).select(*columns, *c.COLUMNS))


def _sums(i: Inputs, kind: str) -> DataFrame:
    sums = pnl.with_previous(c.month_sums(rows_all(i)), c.KEYS, 1)
    return millions(sums.filter(F.col("value_type") == kind))


@query("con_profit_month", f"SELECT source, company, date, {_SIX} FROM {{p0_all}}")
def profit_month(i: Inputs) -> DataFrame:
    return _sums(i, pnl.PROFIT).drop("previous_value", "value_type")


@query("con_prev_month", f"SELECT source, company, date, value_type, {s.money('value, previous_value', 6)} FROM {{p_all}}")
def prev_month(i: Inputs) -> DataFrame:
    return _sums(i, pnl.PROFIT)


@query("con_revenue_month", f"SELECT source, company, date, value_type, {s.money('value, previous_value', 6)} FROM {{str_all}}")
def revenue_month(i: Inputs) -> DataFrame:
    return _sums(i, pnl.TOTAL_REVENUE)


@query("con_revenue_year", f"SELECT source, company, date, {_SIX} FROM {{year_revenue_all}}")
def revenue_year(i: Inputs) -> DataFrame:
    return millions(c.year_revenue(c.month_sums(rows_all(i))).drop("value_type"))


@query("con_stacked", f"SELECT * EXCLUDE (value, previous_value), {s.money('value, previous_value', 6)} FROM {{erc_all}}")
def stacked(i: Inputs) -> DataFrame:
    rows = rows_all(i)
    out = c.stacked(rows, pnl.with_previous(c.month_sums(rows), c.KEYS, 1))
    return millions(out.select(*c.CONSOLIDATED_OUTPUT[:-1]))


_REPORT = f"""SELECT c.* EXCLUDE (value, previous_value), {s.money('c.value, c.previous_value', 6)}, CAST(r.value AS DECIMAL(28,6)) AS str_value
        FROM {{erc_all}} c LEFT JOIN {{year_revenue_all}} r
          ON r.date = CAST(date_trunc('year', c.date) AS DATE) AND r.source = c.source AND r.company = c.company"""


@query("con_plan_actual", _REPORT)
def plan_actual_all(i: Inputs) -> DataFrame:
    return millions(c.consolidated(CODES, i.tables, i.star))


def stored_reports(i: Inputs) -> dict[str, str]:
    """All entities' reports as tables, laid out by source and row class; each date is checked."""
    schema = workspace(i)
    for name, spec in SPECS.items():
        report = plan_actual(spec, i.tables, i.star)
        materialise(report, f"{schema}.{name}", ("source", "value_type"), ("expense_type_5_id",), Gate(not_null=("date",)))
    return {name: f"{schema}.{name}" for name in SPECS}


@query("con_from_reports", _REPORT)
def from_reports(i: Inputs) -> DataFrame:
    """The consolidation from the stored reports of all entities, read by their names."""
    details = c.stored_details(i.spark, stored_reports(i))
    return millions(c.consolidate(CODES, details, i.tables, i.star))
