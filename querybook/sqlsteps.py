"""SQL steps the counterparts share, written apart from the DataFrame code they check."""

from __future__ import annotations

from querybook.registry import cte

F2 = ("financial_report_value", "management_report_value")


def _silver(name: str, measures=F2, keys=("expense_code", "department_code"), texts=(), bad=(), date="accounting_date"):
    cols = [date]
    cols += [f"coalesce({m}, 0) AS {m}" for m in measures]
    cols += [f"coalesce(trim(upper({k})), ' ') AS {k}" for k in keys]
    cols += [f"{expr} AS {alias}" for expr, alias in texts]
    reject = ["(" + " AND ".join(f"{m} = 0" for m in measures) + ")"]
    reject += [f"{k} = '{v}'" for k in keys for v in (" ", "0")]
    reject += [f"expense_code = '{v}'" for v in bad]
    cte(
        f"s_{name}",
        f"SELECT * FROM (SELECT {', '.join(cols)} FROM {{b_{name}}}) AS x WHERE NOT ({' OR '.join(reject)})",
    )


_GL = (("coalesce(trim(general_ledger_code), ' ')", "general_ledger_code"),)
_GL_EMPTY = (("coalesce(trim(general_ledger_code), '')", "general_ledger_code"),)
_COURSE = (
    ("coalesce(course, ' ')", "course"),
    ("coalesce(cost_by_class, ' ')", "cost_by_class"),
    ("coalesce(general_ledger_code, ' ')", "general_ledger_cod"),
)

for _n in ("main_ledger", "main_ledger_planning"):
    _silver(_n, texts=_GL_EMPTY)
for _n in (
    "main_adjustment",
    "main_adjustment_planning",
    "it_services_ledger",
    "it_services_overseas_ledger",
    "training_ledger",
    "training_adjustment",
):
    _silver(_n, texts=_GL)
for _n in (
    "it_services_exclusion",
    "it_services_ledger_planning",
    "it_services_revenue_planning",
    "training_ledger_planning",
    "solutions_detail",
    "solutions_detail_planning",
    "japan_ledger_planning",
    "japan_adjustment",
    "japan_adjustment_planning",
    "japan_revenue_planning",
    "korea_adjustment",
    "korea_adjustment_planning",
    "korea_revenue_planning",
    "cloud_ledger",
    "cloud_ledger_planning",
    "partner_ledger",
    "partner_ledger_planning",
):
    _silver(_n)
for _n in ("japan_ledger", "japan_allocation"):
    _silver(_n, measures=("financial_report_value",))
for _n in ("korea_ledger", "korea_ledger_planning", "education_ledger_planning"):
    _silver(_n, bad=("90C",))
_silver("education_ledger", texts=_COURSE, bad=("90C",))
for _n in ("elimination", "elimination_planning"):
    _silver(_n, measures=("management_report_value",), texts=(("coalesce(trim(type), ' ')", "type"),))
for _n in ("exchange_rate", "exchange_rate_planning"):
    _silver(_n, measures=("rate_value",), keys=("department_code",))
_silver("peer_fact", measures=("value",), date="date")

cte("s_dim_ob", "SELECT ob_id, ob_code, ob_type_1_code, ob_type_2_code, ob_type_3_code FROM {b_dim_ob}")
cte(
    "s_dim_department",
    """SELECT coalesce(trim(upper(department_code)), ' ') AS department_code, deparment_id, ob_id, unit_id,
              business_unit_1_id, coalesce(trim(business_unit_1_name), ' ') AS business_unit_1_name,
              business_unit_2_id, coalesce(trim(business_unit_2_name), ' ') AS business_unit_2_name,
              business_unit_3_id, coalesce(trim(business_unit_3_name), ' ') AS business_unit_3_name
       FROM {b_dim_department}""",
)
cte(
    "s_dim_expense_type",
    "SELECT coalesce(trim(upper(expense_code)), ' ') AS expense_code, expense_type_1_id, expense_type_5_id FROM {b_dim_expense_type}",
)
cte(
    "s_dim_expense_type_2",
    "SELECT expense_type_id, coalesce(expense_type_name, ' ') AS expense_type_name, coalesce(expense_type_name_2, ' ') AS expense_type_name_2 FROM {b_dim_expense_type_2}",
)
for _n in ("dim_expense_type_3", "dim_expense_type_4", "dim_expense_type_5"):
    cte(
        f"s_{_n}", f"SELECT expense_type_id, coalesce(expense_type_name, ' ') AS expense_type_name FROM {{b_{_n}}}"
    )
cte("s_dim_revenue", "SELECT revenue_id, coalesce(revenue_name, ' ') AS revenue_name FROM {b_dim_revenue}")

cte(
    "d_expense",
    """SELECT t.expense_code, t.expense_type_5_id, n.expense_type_name AS expense_type_5_name
       FROM {s_dim_expense_type} t LEFT JOIN {s_dim_expense_type_5} n ON n.expense_type_id = t.expense_type_5_id""",
)
cte(
    "d_department",
    """SELECT d.department_code, d.business_unit_1_id, d.business_unit_1_name, d.business_unit_2_id,
              d.business_unit_2_name, d.business_unit_3_id, o.ob_code
       FROM {s_dim_department} d LEFT JOIN {s_dim_ob} o ON o.ob_id = d.ob_id""",
)

_DIMS = """e.expense_code, e.expense_type_5_id, e.expense_type_5_name, d.department_code, d.business_unit_1_id,
    d.business_unit_1_name, d.business_unit_2_id, d.business_unit_2_name, d.business_unit_3_id, d.ob_code"""


def ledger_union(measure: str, actual: list[str], planning: list[str]) -> str:
    """SELECT over ledgers; an item is a step name or a whole SELECT of the four columns."""

    def one(item: str, source: str) -> str:
        body = item
        if not item.startswith("SELECT"):
            body = f"SELECT accounting_date AS date, {measure} AS value, department_code, expense_code FROM {{s_{item}}}"
        return f"SELECT '{source}' AS source, q.* FROM ({body}) AS q"

    return " UNION ALL ".join([one(i, "actual") for i in actual] + [one(i, "planning") for i in planning])


def enriched(fact: str, fold: str = "upper", where: str = "TRUE", value: str = "f.value", extra: str = "") -> str:
    def key(c: str) -> str:
        return f"{fold}({c})" if fold else c

    return f"""SELECT f.source, f.date, {value} AS value,
        CASE WHEN e.expense_type_5_id = 18 OR e.expense_type_5_id = 19 THEN 'r' ELSE 'e' END AS value_type, {_DIMS}{extra}
        FROM {{{fact}}} f
        LEFT JOIN {{d_expense}} e ON {key('e.expense_code')} = {key('f.expense_code')}
        LEFT JOIN {{d_department}} d ON {key('d.department_code')} = {key('f.department_code')}
        WHERE {where}"""


MAIN_ACTUAL = ["main_ledger", "main_adjustment"]
MAIN_PLANNING = ["main_ledger_planning", "main_adjustment_planning"]
FIN, MAN = F2
FLIP = "CASE WHEN f.source = 'planning' AND e.expense_type_5_id NOT IN (18, 19) THEN -f.value ELSE f.value END"

_TAKEOVER = """SELECT m.accounting_date AS date,
        CAST(CAST(m.financial_report_value AS DOUBLE) / CAST(coalesce(r.rate_value, 1) AS DOUBLE) AS DECIMAL(24,10)) AS value,
        m.department_code, m.expense_code
    FROM {s_main_ledger} m LEFT JOIN {s_exchange_rate} r
      ON date_trunc('month', r.accounting_date) = date_trunc('month', m.accounting_date) AND r.department_code = 'DEP-2'
    WHERE m.department_code = 'DEP-2' AND year(m.accounting_date) = 1996"""
_ALLOCATED = """SELECT accounting_date AS date, financial_report_value AS value, department_code, expense_code
    FROM {s_japan_allocation} WHERE department_code = 'DEP-5'"""
cte("f_takeover", _TAKEOVER)

cte("f_main_fin", ledger_union(FIN, MAIN_ACTUAL, MAIN_PLANNING))
cte("f_main_man", ledger_union(MAN, MAIN_ACTUAL, MAIN_PLANNING))
cte("f_education", ledger_union(MAN, ["education_ledger"], ["education_ledger_planning"]))
cte(
    "f_it_services",
    ledger_union(
        MAN,
        ["it_services_ledger", "it_services_exclusion", "it_services_overseas_ledger"],
        ["it_services_ledger_planning", "it_services_revenue_planning"],
    ),
)
cte("f_training", ledger_union(MAN, ["training_ledger", "training_adjustment"], ["training_ledger_planning"]))
cte(
    "f_japan",
    ledger_union(
        FIN,
        ["japan_ledger", "SELECT * FROM {f_takeover}", _ALLOCATED, "japan_adjustment"],
        ["japan_ledger_planning", "japan_adjustment_planning", "japan_revenue_planning"],
    ),
)
cte(
    "f_korea",
    ledger_union(
        MAN,
        ["korea_ledger", "korea_adjustment"],
        ["korea_ledger_planning", "korea_adjustment_planning", "korea_revenue_planning"],
    ),
)
cte("f_detail", ledger_union(MAN, ["solutions_detail"], ["solutions_detail_planning"]))

cte("er_apac", enriched("f_main_fin", where="d.ob_code = 'APAC'"))
cte("er_education", enriched("f_education"))
cte("er_it_services", enriched("f_it_services", fold="", value=FLIP))
cte("er_solutions_main", enriched("f_main_man", where="d.ob_code = 'SNP'"))
cte("er_solutions_detail", enriched("f_detail", value="f.value * 1000000"))
cte("er_solutions", "SELECT * FROM {er_solutions_main} UNION ALL SELECT * FROM {er_solutions_detail}")
cte("er_training", enriched("f_training"))
cte("er_japan", enriched("f_japan"))
cte("er_korea", enriched("f_korea", value=FLIP))
cte("er_vietnam_main", enriched("f_main_man", where="d.ob_code = 'VN'"))
cte(
    "er_vietnam_carved",
    enriched("f_detail", value="f.value * -1000000", where="upper(f.department_code) = 'DEP-7'"),
)
cte("er_vietnam", "SELECT * FROM {er_vietnam_main} UNION ALL SELECT * FROM {er_vietnam_carved}")
cte("er_group", enriched("f_main_fin", fold="lower", where="d.ob_code = 'GROUP'"))
cte("er_regional", enriched("f_main_fin", fold="lower", where="d.ob_code = 'REG'"))

BY_MONTH = ("apac", "education", "it_services", "solutions", "training", "japan", "korea", "vietnam")
BY_DEPARTMENT = ("group", "regional")


def _sums(name: str, rows: str, kind: str, where: str, keys: list[str], unit: str, lag: str, value: str = "value") -> None:
    k = ", ".join(keys)
    on = " AND ".join(f"a.{c} = b.{c}" for c in keys if c != "ob_code")
    cte(
        f"{kind}0_{name}",
        f"SELECT {k}, CAST(date_trunc('{unit}', date) AS DATE) AS date, sum({value}) AS value FROM {{{rows}}} WHERE {where} GROUP BY {k}, CAST(date_trunc('{unit}', date) AS DATE)",
    )
    cte(
        f"{kind}_{name}",
        f"SELECT a.*, b.value AS previous_value, '{kind}' AS value_type FROM {{{kind}0_{name}}} a LEFT JOIN {{{kind}0_{name}}} b ON a.date = b.date + INTERVAL 1 {lag} AND {on}",
    )


_SIGNED = "CASE value_type WHEN 'e' THEN -value ELSE value END"
for _n in BY_MONTH:
    _sums(_n, f"er_{_n}", "p", "expense_type_5_id <> 19", ["source"], "month", "MONTH")
    _sums(_n, f"er_{_n}", "np", "TRUE", ["source"], "month", "MONTH")
    _sums(_n, f"er_{_n}", "str", "expense_type_5_id = 18", ["source"], "month", "MONTH")
for _n in BY_DEPARTMENT:
    _keys = ["source", "department_code", "ob_code"]
    _sums(_n, f"er_{_n}", "p", "expense_type_5_id <> 19", _keys, "year", "YEAR", _SIGNED)
    _sums(_n, f"er_{_n}", "np", "TRUE", _keys, "year", "YEAR", _SIGNED)
    _sums(_n, f"er_{_n}", "str", "expense_type_5_id = 18", _keys, "month", "YEAR")


def label(plain: str) -> str:
    return f"CASE WHEN business_unit_2_id NOT IN ({plain}) THEN business_unit_1_name || '-' || business_unit_2_name ELSE business_unit_1_name END"


def stacked(name: str, plain: str = "0", kinds=("p", "np", "str"), by_department: bool = False, company: bool = False) -> str:
    extra = "company, " if company else ""
    bu3 = "business_unit_3_id, " if by_department else ""
    detail = f"""SELECT date, value, value_type, expense_code, expense_type_5_id, expense_type_5_name, department_code,
        business_unit_1_id, business_unit_1_name, business_unit_2_id, business_unit_2_name, {bu3}
        {label(plain)} AS business_unit_3_name, ob_code, {extra}source, NULL AS previous_value FROM {{er_{name}}}"""
    parts = [detail]
    for kind in kinds:
        code, dept, ob = ("''", "department_code", "ob_code") if by_department else ("NULL", "NULL", "''")
        bu3_null = "NULL, " if by_department else ""
        parts.append(
            f"SELECT date, value, value_type, {code}, NULL, '', {dept}, NULL, '', NULL, '', {bu3_null}'', {ob}, {extra}source, previous_value FROM {{{kind}_{name}}}"
        )
    return cte(f"erc_{name}", " UNION ALL ".join(parts))


def money(columns: str, scale: int = 2) -> str:
    return ", ".join(f"CAST({c.strip()} AS DECIMAL(28,{scale})) AS {c.strip().split('.')[-1]}" for c in columns.split(","))


def attached(name: str, value: str = "r.value") -> str:
    """The whole dataset of an entity."""
    if name in BY_DEPARTMENT:
        on = "r.date = CAST(date_trunc('year', c.date) AS DATE) AND r.source = c.source AND r.department_code = c.department_code"
    else:
        on = "r.date = CAST(date_trunc('month', c.date) AS DATE) AND r.source = c.source"
    return f"""SELECT c.* EXCLUDE (value, previous_value), {money('c.value, c.previous_value')},
        CAST({value} AS DECIMAL(28,2)) AS str_value FROM {{erc_{name}}} c LEFT JOIN {{str_{name}}} r ON {on}"""


for _n in BY_MONTH:
    stacked(_n)
for _n in BY_DEPARTMENT:
    stacked(_n, plain="0, 2", by_department=True)
