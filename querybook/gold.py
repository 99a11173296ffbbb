"""Plan-versus-actual queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import unit_label
from ledgerloom.operators import pnl
from ledgerloom.operators.currency import fx_divide, rate_lookup
from ledgerloom.plans import entities as e
from ledgerloom.sources.tables import materialise
from ledgerloom.sources.workspace import fresh_folder
from querybook import sqlsteps as s
from querybook.fixtures import CODES, Inputs
from querybook.registry import query

SPECS = e.entities(CODES)
MONEY = "decimal(28,2)"


def money(df: DataFrame, *columns: str) -> DataFrame:
    """Amounts at cents, so that both engines show the same digits."""
    names = columns or [c for c in ("value", "previous_value", "str_value") if c in df.columns]
    return df.withColumns({c: F.col(c).cast(MONEY) for c in names})


def rows_of(i: Inputs, name: str) -> DataFrame:
    return e.pnl_rows(SPECS[name], i.tables, i.star)


def sums_of(i: Inputs, name: str) -> DataFrame:
    return e.subtotals(SPECS[name], rows_of(i, name))


@query(
    "gld_fact_union",
    "SELECT accounting_date, financial_report_value, management_report_value, department_code, expense_code FROM {s_main_ledger} "
    "UNION ALL SELECT accounting_date, financial_report_value, management_report_value, department_code, expense_code FROM {s_main_adjustment}",
)
def fact_union(i: Inputs) -> DataFrame:
    columns = ("accounting_date", *s.F2, "department_code", "expense_code")
    return pnl.union_facts([i.tables[t] for t in s.MAIN_ACTUAL], columns)


@query("gld_tag_source", "SELECT source, date, value, department_code, expense_code FROM {f_main_fin}")
def tag_source(i: Inputs) -> DataFrame:
    return e.fact_rows(SPECS["apac"], i.tables)


@query("gld_dim_expense", "SELECT * FROM {d_expense}")
def dim_expense(i: Inputs) -> DataFrame:
    return i.star.expense.df


@query("gld_dim_department", "SELECT * FROM {d_department}")
def dim_department(i: Inputs) -> DataFrame:
    return i.star.department.df


_DIM_COLUMNS = "expense_code, expense_type_5_id, expense_type_5_name, department_code, business_unit_1_name, business_unit_2_name, ob_code"


@query(
    "gld_enrich",
    " UNION ALL ".join(
        f"SELECT '{case}' AS key_case, source, date, {s.money('value')}, {_DIM_COLUMNS} FROM {{{step}}}"
        for case, step in (
            ("upper", s.cte("er_main_upper", s.enriched("f_main_fin"))),
            ("lower", s.cte("er_main_lower", s.enriched("f_main_fin", "lower"))),
            ("raw", s.cte("er_main_raw", s.enriched("f_main_fin", ""))),
        )
    ),
)
def enrich(i: Inputs) -> DataFrame:
    fact = e.fact_rows(SPECS["apac"], i.tables)
    columns = ["source", "date", "value", *_DIM_COLUMNS.split(", ")]
    upper, lower, raw = (
        money(pnl.enrich(fact, i.star.expense, i.star.department, case).select(*columns)).withColumn(
            "key_case", F.lit(case)
        )
        for case in ("upper", "lower", "raw")
    )
    return upper.unionByName(lower).unionByName(raw)


@query(
    "gld_classify",
    "SELECT expense_type_5_id, value_type, count(*) AS n FROM {er_education} GROUP BY expense_type_5_id, value_type",
)
def classify(i: Inputs) -> DataFrame:
    return rows_of(i, "education").groupBy("expense_type_5_id", "value_type").agg(F.count(F.lit(1)).alias("n"))


_ROWS = "source, date, value_type, expense_code, expense_type_5_id, department_code, ob_code"


def _detail(df: DataFrame) -> DataFrame:
    return money(df.select(*_ROWS.split(", "), "value"))


@query(
    "gld_pnl_rows",
    f"SELECT 'financial' AS measure, {_ROWS}, {s.money('value')} FROM {{er_japan}} UNION ALL SELECT 'management', {_ROWS}, {s.money('value')} FROM {{er_training}}",
)
def pnl_rows(i: Inputs) -> DataFrame:
    financial = _detail(rows_of(i, "japan")).withColumn("measure", F.lit("financial"))
    return financial.unionByName(_detail(rows_of(i, "training")).withColumn("measure", F.lit("management")))


@query("gld_planned_sign", f"SELECT {_ROWS}, {s.money('value')} FROM {{er_korea}}")
def planned_sign(i: Inputs) -> DataFrame:
    return _detail(rows_of(i, "korea"))


@query("gld_entity_filter", f"SELECT {_ROWS}, {s.money('value')} FROM {{er_apac}}")
def entity_filter(i: Inputs) -> DataFrame:
    return _detail(rows_of(i, "apac"))


@query("gld_detail_rescale", f"SELECT {_ROWS}, {s.money('value')} FROM {{er_solutions_detail}}")
def detail_rescale(i: Inputs) -> DataFrame:
    spec = SPECS["solutions"]
    fact = e.detail_rows(spec.detail, spec.measure, i.tables)
    rows = pnl.enrich(fact, i.star.expense, i.star.department)
    return _detail(rows.withColumn("value_type", pnl.classify(F.col("expense_type_5_id"))))


@query("gld_carve_out", f"SELECT {_ROWS}, {s.money('value')} FROM {{er_vietnam}}")
def carve_out(i: Inputs) -> DataFrame:
    return _detail(rows_of(i, "vietnam"))


@query(
    "gld_fx_divide",
    """SELECT m.accounting_date, m.department_code, m.expense_code,
              CAST(CAST(m.financial_report_value AS DOUBLE) / CAST(coalesce(r.rate_value, 1) AS DOUBLE) AS DECIMAL(24,6)) AS value
       FROM {s_main_ledger} m LEFT JOIN (SELECT * FROM {s_exchange_rate} WHERE department_code = 'DEP-2') r
         ON year(r.accounting_date) = year(m.accounting_date) AND month(r.accounting_date) = month(m.accounting_date)""",
)
def fx_division(i: Inputs) -> DataFrame:
    rows = i.tables["main_ledger"].select(
        "accounting_date", "department_code", "expense_code", F.col("financial_report_value").alias("value")
    )
    rates = rate_lookup(i.tables["exchange_rate"], CODES.japan_department)
    return fx_divide(rows, rates, "accounting_date", "value").withColumn("value", F.col("value").cast("decimal(24,6)"))


@query(
    "gld_branch_filter",
    """SELECT 'takeover' AS branch, date, CAST(value AS DECIMAL(24,6)) AS value, department_code, expense_code FROM {f_takeover}
       UNION ALL SELECT 'allocation', accounting_date, financial_report_value, department_code, expense_code
       FROM {s_japan_allocation} WHERE department_code = 'DEP-5'""",
)
def branch_filter(i: Inputs) -> DataFrame:
    spec = SPECS["japan"]
    takeover, allocation = (
        e.branch_rows(spec.actual[n], spec.measure, i.tables)
        .withColumn("value", F.col("value").cast("decimal(24,6)"))
        .withColumn("branch", F.lit(name))
        for n, name in ((1, "takeover"), (2, "allocation"))
    )
    return takeover.unionByName(allocation)


def _monthly(key: str, kind: str) -> None:
    sql = " UNION ALL ".join(
        f"SELECT '{name}' AS entity, source, date, {s.money('value')} FROM {{{kind}0_{name}}}"
        for name in ("vietnam", "japan")
    )

    @query(key, sql)
    def build(i: Inputs) -> DataFrame:
        vietnam, japan = (
            money(
                pnl.period_sums(rows_of(i, name), ["source"], {kind: pnl.monthly_kinds()[kind]})
                .drop("value_type")
                .withColumn("entity", F.lit(name))
            )
            for name in ("vietnam", "japan")
        )
        return vietnam.unionByName(japan)


_monthly("gld_profit_month", pnl.PROFIT)
_monthly("gld_net_profit_month", pnl.NET_PROFIT)
_monthly("gld_revenue_month", pnl.TOTAL_REVENUE)


def _all_kinds(name: str, columns: str) -> str:
    return " UNION ALL ".join(f"SELECT {columns} FROM {{{k}_{name}}}" for k in ("p", "np", "str"))


@query(
    "gld_profit_year_dept",
    _all_kinds("group", f"value_type, source, department_code, ob_code, date, {s.money('value')}"),
)
def profit_year_dept(i: Inputs) -> DataFrame:
    return money(sums_of(i, "group").drop("previous_value"))


@query(
    "gld_prev_month", _all_kinds("education", f"value_type, source, date, {s.money('value, previous_value')}")
)
def prev_month(i: Inputs) -> DataFrame:
    return money(sums_of(i, "education"))


@query(
    "gld_prev_year",
    _all_kinds("regional", f"value_type, source, department_code, ob_code, date, {s.money('value, previous_value')}"),
)
def prev_year(i: Inputs) -> DataFrame:
    return money(sums_of(i, "regional"))


@query("gld_stacked", f"SELECT * EXCLUDE (value, previous_value), {s.money('value, previous_value')} FROM {{erc_it_services}}")
def stack(i: Inputs) -> DataFrame:
    spec = SPECS["it_services"]
    rows = rows_of(i, "it_services")
    out = e.stacked(spec, rows, e.subtotals(spec, rows))
    return money(out.select(*e.OUTPUT[:-1]))


@query(
    "gld_unit_label",
    f"SELECT department_code, {s.label('0')} AS label, {s.label('0, 2')} AS label_by_department FROM {{s_dim_department}}",
)
def unit_labels(i: Inputs) -> DataFrame:
    names = (F.col("business_unit_1_name"), F.col("business_unit_2_id"), F.col("business_unit_2_name"))
    return i.tables["dim_department"].select(
        "department_code", unit_label(*names).alias("label"), unit_label(*names, (0, 2)).alias("label_by_department")
    )


def _report(key: str, name: str, sql: str | None = None, **options) -> None:
    @query(key, sql or s.attached(name), stored=True)
    def build(i: Inputs) -> DataFrame:
        return money(e.plan_actual(SPECS[name], i.tables, i.star, **options))


_report("gld_plan_actual", "vietnam")
_report("gld_attach_revenue", "education")
_report("gld_attach_revenue_zero", "training", s.attached("training", "coalesce(r.value, 0)"))
_report("gld_attach_revenue_jan", "group")
s.cte(
    "str_year_group",
    "SELECT source, department_code, CAST(date_trunc('year', date) AS DATE) AS date, sum(value) AS value FROM {str0_group} GROUP BY ALL",
)
_report(
    "gld_attach_revenue_year", "group", s.attached("group").replace("{str_group}", "{str_year_group}"), yearly_revenue=True
)
for _name in ("apac", "it_services", "solutions", "japan", "korea", "regional"):
    _report(f"gld_dataset_{_name}", _name)


def workspace(i: Inputs) -> str:
    """A catalog schema of its own for one run, in the shared folder."""
    folder = fresh_folder(i.spark)
    schema = folder.rsplit("/", 1)[1].replace("-", "_")
    i.spark.sql(f"CREATE DATABASE {schema} LOCATION '{folder}'")
    return schema


@query("gld_materialise", s.attached("apac"))
def materialised_report(i: Inputs) -> DataFrame:
    report = e.plan_actual(SPECS["apac"], i.tables, i.star)
    return money(materialise(report, f"{workspace(i)}.apac"))


@query(
    "gld_layout_scan",
    f"SELECT * FROM ({s.attached('apac')}) AS x WHERE source = 'actual' AND value_type = 'r' AND expense_type_5_id = 18",
)
def layout_scan(i: Inputs) -> DataFrame:
    report = e.plan_actual(SPECS["apac"], i.tables, i.star)
    table = materialise(
        report, f"{workspace(i)}.apac", partition_by=("source", "value_type"), sort_by=("expense_type_5_id",)
    )
    wanted = (F.col("source") == "actual") & (F.col("value_type") == "r") & (F.col("expense_type_5_id") == 18)
    return money(table.filter(wanted).select(*e.OUTPUT))
