"""Step-down allocation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

from ledgerloom.operators import allocation as a
from querybook import sqlsteps  # noqa: F401
from querybook.fixtures import ALLOCATION_CODES, Inputs
from querybook.registry import ORACLES, cte, query


def rounded(df: DataFrame) -> DataFrame:
    """Measures as doubles at four digits."""
    names = [f.name for f in df.schema if isinstance(f.dataType, (DecimalType, DoubleType))]
    return df.withColumns({n: F.round(F.col(n).cast("double"), 4) for n in names})


def r4(columns: str) -> str:
    return ", ".join(f"round(CAST({n.strip()} AS DOUBLE), 4) AS {n.strip()}" for n in columns.split(","))


cte(
    "a_dept",
    "SELECT d.department_code, d.unit_id, o.ob_code FROM {s_dim_department} d LEFT JOIN {s_dim_ob} o ON o.ob_id = d.ob_id",
)
_M6 = "CAST({c} * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(24,10))"
cte(
    "a_raw",
    " UNION ALL ".join(
        f"""SELECT accounting_date AS date, {_M6.format(c='bctc')} AS financial_report_value,
            {_M6.format(c='bcqt')} AS management_report_value, fee_code AS expense_code, department_id AS department_code, gl3_code FROM {{b_{t}}}"""
        for t in ("allocation_ledger", "allocation_adjustment")
    ),
)
cte(
    "a_ledger",
    """SELECT l.*, f.fee_type_1, f.fee_type_2, f.fee_type_3, f.fee_type_4, f.type_id, d.unit_id, d.ob_code
       FROM {a_raw} l LEFT JOIN {b_dim_feecode} f ON upper(f.code) = upper(l.expense_code)
       LEFT JOIN {a_dept} d ON upper(d.department_code) = upper(l.department_code)""",
)
cte(
    "a_mm_rows",
    """SELECT m.accounting_date AS date, m.value, m.type_id, m.department_id AS department_code, d.unit_id, d.ob_code
       FROM {b_man_month} m LEFT JOIN {a_dept} d ON upper(d.department_code) = upper(m.department_id)""",
)
cte(
    "a_expense",
    "SELECT date, ob_code, unit_id, department_code, sum(management_report_value) AS value FROM {a_ledger} WHERE fee_type_3 = 'EXPENSE' GROUP BY ALL",
)
cte(
    "a_mm", "SELECT date, type_id, ob_code, unit_id, department_code, sum(value) AS value FROM {a_mm_rows} GROUP BY ALL"
)
cte("a_pool_support", "SELECT * FROM {a_expense} WHERE unit_id = 5")
cte(
    "a_base_support",
    """SELECT *, sum(value) OVER (PARTITION BY date) AS calendar_mm_total FROM {a_mm}
       WHERE type_id = 'MM001' AND ob_code = 'VN' AND unit_id IN (1, 13, 14)""",
)
_SHARE = "CAST({mm} AS DOUBLE) * CAST({pool} AS DOUBLE) / nullif(CAST({total} AS DOUBLE), 0)"
cte(
    "a_support",
    f"""SELECT b.date, b.unit_id, p.department_code AS department_distribute_code, b.department_code,
              p.value AS expense, b.value AS calendar_mm, b.calendar_mm_total,
              {_SHARE.format(mm='b.value', pool='p.value', total='b.calendar_mm_total')} AS distribution
       FROM {{a_base_support}} b FULL JOIN {{a_pool_support}} p ON b.date = p.date""",
)
cte("a_pool_bo", "SELECT date, sum(value) AS value FROM {a_expense} WHERE unit_id = 7 AND ob_code = 'VN' GROUP BY date")
cte(
    "a_total_bo",
    """SELECT date, sum(value) AS value FROM {a_mm} WHERE type_id = 'MM001' AND ob_code IN ('VN', 'SNP')
       AND department_code NOT IN ('dep-3', 'dep-4') GROUP BY date""",
)
cte(
    "a_bo",
    f"""SELECT m.date, m.unit_id, m.department_code, p.value AS expense, m.value AS calendar_mm, t.value AS calendar_mm_total,
              {_SHARE.format(mm='m.value', pool='p.value', total='t.value')} AS distribution
       FROM {{a_mm}} m LEFT JOIN {{a_total_bo}} t ON t.date = m.date LEFT JOIN {{a_pool_bo}} p ON p.date = m.date
       WHERE m.type_id = 'MM001' AND m.ob_code = 'VN' AND m.unit_id IN (1, 13, 14, 2, 3, 11)""",
)
for _service, _is_pool in (("comtor", "upper({c}) = 'DEP-1'"), ("qa", "{c} = 'dep-2'")):
    _pool = _is_pool.format(c="department_code")
    cte(
        f"a_pool_{_service}",
        f"""SELECT date, sum(value) AS expense_value FROM (
              SELECT date, department_code, CAST(value AS DOUBLE) AS value FROM {{a_expense}}
              UNION ALL SELECT date, department_code, distribution FROM {{a_support}}
              UNION ALL SELECT date, department_code, distribution FROM {{a_bo}}) AS u WHERE {_pool} GROUP BY date""",
    )
    cte(
        f"a_effort_{_service}",
        f"""SELECT e.accounting_date AS date, e.effort, e.department_id AS department_code, p.expense_value, m.value AS man_month_value
            FROM {{b_effort}} e LEFT JOIN {{a_pool_{_service}}} p ON p.date = e.accounting_date
            LEFT JOIN (SELECT * FROM {{a_mm}} WHERE type_id = 'MM001' AND {_pool}) m ON m.date = e.accounting_date""",
    )
    cte(
        f"a_twice_{_service}",
        f"""SELECT date, effort, department_code, expense_value, man_month_value FROM {{a_effort_{_service}}}
            UNION ALL SELECT date, effort, 'Overhead', expense_value, man_month_value FROM {{a_effort_{_service}}} WHERE NOT ({_pool})""",
    )
    cte(
        f"a_{_service}",
        f"""SELECT date, department_code, v AS value, v * x / nullif(m, 0) AS distribution_regular FROM (
              SELECT date, department_code, avg(expense_value) AS x, avg(man_month_value) AS m,
                CASE WHEN department_code = 'Overhead' THEN avg(man_month_value) - CAST(sum(effort) AS DOUBLE) ELSE CAST(sum(effort) AS DOUBLE) END AS v
              FROM {{a_twice_{_service}}} GROUP BY date, department_code) AS g""",
    )
_CARRIES = "ob_code IN ('VN', 'SNP') AND upper(department_code) NOT IN ('DEP-1', 'DEP-2', 'DEP-3', 'DEP-4')"
cte(
    "a_base_overhead",
    f"""SELECT date, unit_id, ob_code, department_code, value AS calendar_mm,
               sum(value) FILTER (WHERE {_CARRIES}) OVER (PARTITION BY date) AS calendar_mm_total
        FROM {{a_mm}} WHERE type_id = 'MM001'""",
)
cte(
    "a_overhead",
    f"""SELECT b.date, b.unit_id, b.ob_code, b.department_code, sum(o.x) AS expense, avg(b.calendar_mm) AS calendar_mm,
               avg(b.calendar_mm_total) AS calendar_mm_total,
               avg(b.calendar_mm) * sum(o.x) / nullif(avg(b.calendar_mm_total), 0) AS distribution
        FROM {{a_base_overhead}} b JOIN (
          SELECT date, distribution_regular AS x FROM {{a_comtor}} WHERE department_code = 'Overhead'
          UNION ALL SELECT date, distribution_regular FROM {{a_qa}} WHERE department_code = 'Overhead') o ON o.date = b.date
        WHERE {_CARRIES} GROUP BY b.date, b.unit_id, b.ob_code, b.department_code""",
)

_VALUES = "financial_report_value, management_report_value"
_SUPPORT = f"SELECT date, unit_id, department_distribute_code, department_code, {r4('expense, calendar_mm, calendar_mm_total, distribution')} FROM {{a_support}}"
_SERVICE = "SELECT date, department_code, {v} FROM {{a_{n}}}"


@query(
    "alc_ledger",
    f"""SELECT * EXCLUDE ({_VALUES}), CAST(financial_report_value AS DECIMAL(28,8)) AS financial_report_value,
               CAST(management_report_value AS DECIMAL(28,8)) AS management_report_value FROM {{a_ledger}}""",
)
def ledger(i: Inputs) -> DataFrame:
    return i.step_down.ledger().withColumns({c: F.col(c).cast("decimal(28,8)") for c in _VALUES.split(", ")})


@query("alc_man_month", f"SELECT date, type_id, ob_code, unit_id, department_code, {r4('value')} FROM {{a_mm}}")
def man_month(i: Inputs) -> DataFrame:
    return rounded(i.step_down.man_month_by_department())


@query("alc_expense", f"SELECT date, ob_code, unit_id, department_code, {r4('value')} FROM {{a_expense}}")
def expense(i: Inputs) -> DataFrame:
    return rounded(i.step_down.expense_by_department())


@query("alc_support_total", f"SELECT date, unit_id, department_code, {r4('value, calendar_mm_total')} FROM {{a_base_support}}")
def support_total(i: Inputs) -> DataFrame:
    return rounded(i.step_down.support_base().select("date", "unit_id", "department_code", "value", "calendar_mm_total"))


@query("alc_support", _SUPPORT)
def support(i: Inputs) -> DataFrame:
    return rounded(i.step_down.support())


@query(
    "alc_support_by_dept",
    "SELECT date, department_code, round(sum(distribution), 4) AS distribution FROM {a_support} GROUP BY date, department_code",
)
def support_by_dept(i: Inputs) -> DataFrame:
    return rounded(i.step_down.support_by_department())


@query("alc_bo_total", f"SELECT date, {r4('value')} FROM {{a_total_bo}}")
def bo_total(i: Inputs) -> DataFrame:
    return rounded(i.step_down.bo_total().withColumnRenamed("calendar_mm_total", "value"))


_BO = f"SELECT date, unit_id, department_code, {r4('expense, calendar_mm, calendar_mm_total, distribution')} FROM {{a_bo}}"


@query("alc_bo", _BO)
def bo(i: Inputs) -> DataFrame:
    return rounded(i.step_down.bo())


def _service(name: str) -> None:
    service = getattr(ALLOCATION_CODES, name)

    @query(f"alc_pool_{name}", f"SELECT date, {r4('expense_value')} FROM {{a_pool_{name}}}")
    def pool(i: Inputs) -> DataFrame:
        return rounded(i.step_down.service_pool(service))

    @query(f"alc_{name}", f"SELECT date, department_code, {r4('value, distribution_regular')} FROM {{a_{name}}}")
    def allocated(i: Inputs) -> DataFrame:
        return rounded(i.step_down.service(service))


_service("comtor")
_service("qa")


@query(
    "alc_effort",
    " UNION ALL ".join(
        f"SELECT '{n}' AS service, date, department_code, {r4('effort, expense_value, man_month_value')} FROM {{a_effort_{n}}}"
        for n in ("comtor", "qa")
    ),
)
def effort(i: Inputs) -> DataFrame:
    comtor, qa = (
        rounded(i.step_down.effort(getattr(ALLOCATION_CODES, n))).withColumn("service", F.lit(n)) for n in ("comtor", "qa")
    )
    return comtor.unionByName(qa)


@query(
    "alc_effort_overhead",
    " UNION ALL ".join(
        f"SELECT '{n}' AS service, date, department_code, {r4('effort, expense_value, man_month_value')} FROM {{a_twice_{n}}}"
        for n in ("comtor", "qa")
    ),
)
def effort_overhead(i: Inputs) -> DataFrame:
    def doubled(name: str) -> DataFrame:
        service = getattr(ALLOCATION_CODES, name)
        rows = a.with_overhead_rows(i.step_down.effort(service), service.is_pool(F.col("department_code")))
        return rounded(rows).withColumn("service", F.lit(name))

    return doubled("comtor").unionByName(doubled("qa"))


@query(
    "alc_filtered_window",
    f"SELECT date, unit_id, ob_code, department_code, {r4('calendar_mm, calendar_mm_total')} FROM {{a_base_overhead}}",
)
def filtered_window(i: Inputs) -> DataFrame:
    rows = i.step_down.overhead_base()
    return rounded(
        rows.select("date", "unit_id", "ob_code", "department_code", F.col("value").alias("calendar_mm"), "calendar_mm_total")
    )


_OVERHEAD = f"SELECT date, unit_id, ob_code, department_code, {r4('expense, calendar_mm, calendar_mm_total, distribution')} FROM {{a_overhead}}"


@query("alc_overhead", _OVERHEAD)
def overhead(i: Inputs) -> DataFrame:
    return rounded(i.step_down.overhead())


@query("alc_ordered", f"{_SUPPORT} ORDER BY date NULLS LAST, unit_id NULLS LAST, department_code NULLS LAST")
def ordered(i: Inputs) -> DataFrame:
    return a.ordered(rounded(i.step_down.support()), *i.step_down.ORDER["support"])


def _register_ordered() -> None:
    for name in ("bo", "comtor", "qa", "overhead"):

        def build(i: Inputs, name: str = name) -> DataFrame:
            return a.ordered(rounded(getattr(i.step_down, name)()), *i.step_down.ORDER[name])

        query(f"alc_ordered_{name}", ORACLES[f"alc_{name}"])(build)


_register_ordered()
