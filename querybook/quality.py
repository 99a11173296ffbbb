"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.pnl import union_all
from ledgerloom.operators.quality import duplicates, orphans
from ledgerloom.plans import checks
from ledgerloom.plans.entities import plan_actual
from ledgerloom.plans.silver import FACTS
from ledgerloom.sources.tables import CheckFailed, Gate, materialise
from querybook import sqlsteps  # noqa: F401
from querybook.fixtures import Inputs
from querybook.gold import SPECS, workspace
from querybook.registry import query

# The declared keys, and one column that is no key.
_UNIQUE = {**checks.UNIQUE, "dim_department": "unit_id"}


@query(
    "dq_unique",
    " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, CAST({k} AS VARCHAR) AS key, count(*) AS n FROM {{s_{t}}} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1"
        for t, k in _UNIQUE.items()
    ),
)
def unique(i: Inputs) -> DataFrame:
    return checks.unique_violations(i.tables, _UNIQUE)


@query(
    "dq_unique_rate",
    """SELECT accounting_date, department_code, count(*) AS n
       FROM (SELECT * FROM {s_exchange_rate} UNION ALL SELECT * FROM {s_exchange_rate_planning}) AS r
       GROUP BY ALL HAVING count(*) > 1""",
)
def unique_rate(i: Inputs) -> DataFrame:
    """Months whose rate would double the rows it converts if sources were not told apart."""
    rates = i.tables["exchange_rate"].unionByName(i.tables["exchange_rate_planning"])
    return duplicates(rates, "accounting_date", "department_code")


def _orphans(fact: str, key: str) -> str:
    return f"""SELECT '{fact}' AS dataset, '{key}' AS key_column, {key} AS key, count(*) AS n FROM {{s_{fact}}} f
        WHERE NOT EXISTS (SELECT 1 FROM {{s_{checks.KEY_DIMS[key]}}} d WHERE d.{key} = f.{key}) GROUP BY {key}"""


@query("dq_relationships", " UNION ALL ".join(_orphans(n, k) for n, spec in FACTS.items() for k in spec.keys), stored=True)
def relationships(i: Inputs) -> DataFrame:
    return checks.relationship_violations(i.tables)


def stored_facts(i: Inputs) -> dict[str, str]:
    """All conformed facts as tables of one schema."""
    schema = workspace(i)
    for name in FACTS:
        materialise(i.tables[name], f"{schema}.{name}")
    return {name: f"{schema}.{name}" for name in FACTS}


@query(
    "dq_relationships_stored",
    " UNION ALL ".join(_orphans(n, k).replace(" d WHERE ", " d WHERE d.department_code <> 'DEP-3' AND " if k == "department_code" else " d WHERE ") for n, spec in FACTS.items() for k in spec.keys),
    stored=True,
)
def relationships_of_stored_facts(i: Inputs) -> DataFrame:
    """The same over stored facts in one scan, against departments of which one is missing."""
    dims = {n: i.tables[n] for n in checks.KEY_DIMS.values()}
    dims["dim_department"] = dims["dim_department"].filter("department_code <> 'DEP-3'")
    return checks.stored_relationship_violations(i.spark, stored_facts(i), dims)


_GATES = {**{t: ("unique", k) for t, k in checks.UNIQUE.items()}, **{t: ("not_null", c) for t, c in checks.NOT_NULL.items()}}


def _counted(table: str, kind: str, column: str) -> str:
    if kind == "not_null":
        return f"SELECT '{table}' AS dataset, 'nulls' AS check_name, count(*) - count({column}) AS n FROM {{s_{table}}}"
    return f"""SELECT '{table}', 'duplicates', count(*) FROM (SELECT {column} FROM {{s_{table}}} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1) AS x"""


@query(
    "dq_gates",
    " UNION ALL ".join(
        [_counted(t, *check) for t, check in _GATES.items() if check[0] == "not_null"]
        + [_counted(t, *check) for t, check in _GATES.items() if check[0] == "unique"]
        + [f"SELECT '{t}', 'rows', count(*) FROM {{s_{t}}}" for t in checks.NOT_NULL]
    ),
)
def gates(i: Inputs) -> DataFrame:
    """Tables rebuilt behind their declared checks, then rebuilds that these refuse; told is what
    was counted as the rows were written that the tables still hold."""
    schema = workspace(i)
    for name, (kind, column) in _GATES.items():
        table, gate, rows = f"{schema}.{name}", Gate(**{kind: (column,)}), i.tables[name]
        materialise(rows, table, gate=gate)
        broken = rows.withColumn(column, F.lit(None).cast(rows.schema[column].dataType)) if kind == "not_null" else rows.unionByName(rows)
        try:
            materialise(broken, table, gate=gate)
        except CheckFailed:
            continue
        raise AssertionError(f"{table} took rows that its check refuses")
    of = {kind: {n: (f"{schema}.{n}", c) for n, (k, c) in _GATES.items() if k == kind} for kind in ("not_null", "unique")}
    nulls = checks.stored_null_counts(i.spark, of["not_null"]).select("dataset", F.lit("nulls").alias("check_name"), F.col("nulls").alias("n"))
    repeated = checks.stored_duplicates(i.spark, of["unique"])
    repeated = repeated.select("dataset", F.lit("duplicates").alias("check_name"), F.col("duplicates").alias("n"))
    held = [i.spark.table(t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("dataset"), F.lit("rows").alias("check_name"), "n")
            for n, (t, _) in of["not_null"].items()]
    return union_all([nulls, repeated, *held])


@query("dq_orphans", _orphans("peer_fact", "department_code"))
def orphan_departments(i: Inputs) -> DataFrame:
    found = orphans(i.tables["peer_fact"], "department_code", i.tables["dim_department"])
    return found.select(
        F.lit("peer_fact").alias("dataset"),
        F.lit("department_code").alias("key_column"),
        F.col("department_code").alias("key"),
        "n",
    )


@query(
    "dq_orphans_partial",
    """SELECT 'peer_fact' AS dataset, 'department_code' AS key_column, department_code AS key, count(*) AS n FROM {s_peer_fact} f
        WHERE NOT EXISTS (SELECT 1 FROM {s_dim_department} d WHERE d.unit_id <= 9 AND d.department_code = f.department_code)
        GROUP BY department_code""",
)
def orphans_of_some_departments(i: Inputs) -> DataFrame:
    """The same against a dimension that lacks departments, so every scale holds orphans."""
    some = i.tables["dim_department"].filter("unit_id <= 9")
    found = orphans(i.tables["peer_fact"], "department_code", some)
    return found.select(
        F.lit("peer_fact").alias("dataset"),
        F.lit("department_code").alias("key_column"),
        F.col("department_code").alias("key"),
        "n",
    )


_REPORTS = tuple(SPECS)
_ALLOCATIONS = ("support", "bo", "comtor", "qa", "overhead")


@query(
    "dq_not_null",
    " UNION ALL ".join(
        [f"SELECT '{t}' AS dataset, count(*) - count({c}) AS nulls FROM {{s_{t}}}" for t, c in checks.NOT_NULL.items()]
        + [f"SELECT '{n}', count(*) - count(date) FROM {{erc_{n}}}" for n in _REPORTS]
        + [f"SELECT '{n}', count(*) - count(date) FROM {{a_{n}}}" for n in _ALLOCATIONS]
    ),
    stored=True,
)
def not_null(i: Inputs) -> DataFrame:
    datasets = {t: (i.tables[t], c) for t, c in checks.NOT_NULL.items()}
    datasets |= {n: (plan_actual(SPECS[n], i.tables, i.star), checks.REPORT_DATE) for n in _REPORTS}
    datasets |= {n: (getattr(i.step_down, n)(), checks.REPORT_DATE) for n in _ALLOCATIONS}
    return checks.null_counts(datasets)
