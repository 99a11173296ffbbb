"""The consolidated dataset: entities, direct ledgers and eliminations, in millions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import AMOUNT, MILLIONTH, is_decimal, rescale
from ledgerloom.operators import pnl
from ledgerloom.operators.currency import fx_multiply, rate_lookup
from ledgerloom.plans.entities import DETAIL_COLUMNS, EMPTY_TEXT, FINANCIAL, MANAGEMENT, OUTPUT, Codes, all_details, all_facts, entities, routed
from ledgerloom.plans.star import Star, Tables
from ledgerloom.sources.tables import scan

COLUMNS = DETAIL_COLUMNS
_DATE, _VALUE = "accounting_date AS date", f"{MANAGEMENT} AS value"


@dataclass(frozen=True)
class Part:
    """One line of the consolidation: an entity, a direct ledger or a type of elimination.

    Entities report in units and are scaled; the other parts are in millions already.
    """

    segment: str
    entity: str | None = None
    rate_department: str | None = None
    ledger: str | None = None
    elimination: str | None = None


def parts(codes: Codes) -> tuple[Part, ...]:
    outsourcing, it, education, group = "outsourcing", "it", "education", "group"
    return (
        Part(outsourcing, entity="vietnam"),
        Part(outsourcing, entity="regional"),
        Part(outsourcing, entity="japan", rate_department=codes.japan_department),
        Part(outsourcing, entity="korea", rate_department=codes.korea_department),
        Part(outsourcing, entity="apac"),
        Part(outsourcing, entity="it_services"),
        Part(outsourcing, ledger="cloud_ledger"),
        Part(outsourcing, ledger="partner_ledger"),
        Part(outsourcing, elimination=codes.outsourcing_elimination),
        Part(it, entity="solutions"),
        Part(it, elimination=codes.it_elimination),
        Part(education, entity="education"),
        Part(education, entity="training"),
        Part(group, entity="group"),
        Part(group, elimination=codes.group_elimination),
    )


def report_details(report: DataFrame, entity: str) -> DataFrame:
    """The detail rows of a plan-versus-actual dataset; prunes to their folders in a laid-out table."""
    rows = report.filter(F.col("value_type").isin(*pnl.DETAIL_TYPES))
    return rows.select(F.lit(entity).alias("entity"), *COLUMNS)


def stored_details(spark: SparkSession, reports: Mapping[str, str]) -> DataFrame:
    """The detail rows of stored reports (entity to table), laid out by source and row class.

    All reports are one scan, or one for each type their amounts have; only the folders of
    detail rows are listed and read.
    """
    by_type: dict[str, dict[str, str]] = {}
    for entity, table in reports.items():
        by_type.setdefault(spark.table(table).schema["value"].dataType.simpleString(), {})[entity] = table
    found = []
    for kind, tables in by_type.items():
        schema = f"date date, value {kind}, expense_code string, department_code string"
        rows, known = scan(spark, tables, schema, by=("source",), value_type=pnl.DETAIL_TYPES)
        rows = rows.join(F.broadcast(known), "folder")  # a row a folder
        found.append(rows.select(F.col("dataset").alias("entity"), *COLUMNS))
    return pnl.union_all(found)


def direct_ledger(tables: Tables, ledger: str) -> DataFrame:
    actual, planning = (
        tables[name].selectExpr(_DATE, _VALUE, "expense_code", "department_code")
        for name in (ledger, f"{ledger}_planning")
    )
    return pnl.tag_source(actual, planning).select(*COLUMNS)


def eliminations(tables: Tables) -> DataFrame:
    actual, planning = (
        tables[name].selectExpr(_DATE, _VALUE, "expense_code", "department_code", "type")
        for name in ("elimination", "elimination_planning")
    )
    return pnl.tag_source(actual, planning)


def rates(tables: Tables) -> DataFrame:
    return pnl.tag_source(tables["exchange_rate"], tables["exchange_rate_planning"])


def _mapped(column: str, values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col(column)]


def converted(codes: Codes, details: DataFrame, tables: Tables) -> DataFrame:
    """Entity rows in the group's currency: one join converts all entities that report in another."""
    currencies = {p.entity: p.rate_department for p in parts(codes) if p.rate_department is not None}
    rows = details.withColumn("rate_department", _mapped("entity", currencies))
    rate = rate_lookup(rates(tables), *currencies.values())
    return fx_multiply(rows, rate, "date", "value").drop("rate_department")


def routed_eliminations(codes: Codes, tables: Tables) -> DataFrame:
    """Elimination entries with the segment their type belongs to; other types are left out."""
    segments = {p.elimination: p.segment for p in parts(codes) if p.elimination is not None}
    rows = eliminations(tables).filter(F.col("type").isin(*segments))
    return rows.withColumn("segment", _mapped("type", segments)).select("segment", *COLUMNS)


def union_scaled(codes: Codes, details: DataFrame, tables: Tables) -> DataFrame:
    """All parts of the company in millions, with their segments.

    ``details`` has the detail rows of all entities, named in a column ``entity``.
    """
    scaled = _scaled(codes, details, tables).select("segment", *COLUMNS)
    rows = pnl.union_all([scaled, *_in_millions(codes, tables)])
    return rows.withColumn("value", F.col("value").cast(AMOUNT)) if is_decimal(rows, "value") else rows


def _scaled(codes: Codes, details: DataFrame, tables: Tables) -> DataFrame:
    """The entities' rows in millions, with their segments and all their columns."""
    segments = {p.entity: p.segment for p in parts(codes) if p.entity is not None}
    entities = details.filter(F.col("entity").isin(*segments))
    scaled = rescale(converted(codes, entities, tables), "value", MILLIONTH)
    return scaled.withColumn("segment", _mapped("entity", segments))


def _in_millions(codes: Codes, tables: Tables) -> list[DataFrame]:
    """The parts that are in millions already, with their segments."""
    ledgers = [
        direct_ledger(tables, p.ledger).withColumn("segment", F.lit(p.segment))
        for p in parts(codes)
        if p.ledger is not None
    ]
    return [*ledgers, routed_eliminations(codes, tables)]


def tag_company(own: DataFrame, peer_fact: DataFrame, codes: Codes) -> DataFrame:
    """The company's rows and its peer's; a peer only reports actuals."""
    peer = peer_fact.select(*COLUMNS[:-1]).withColumns({"source": F.lit("actual"), "company": F.lit(codes.peer_company)})
    return own.select(*COLUMNS).withColumn("company", F.lit(codes.company)).unionByName(peer)


def consolidated_rows(
    codes: Codes, details: DataFrame, tables: Tables, star: Star
) -> DataFrame:
    """All parts of the company and its peer with their dimensions.

    ``details`` as ``all_details`` gives them, or as ``all_rows`` does: rows that have the columns
    of their dimensions are joined again only where a dimension holds a code twice.
    """
    attributes = [c for c in (*star.department.df.columns, *star.expense.df.columns) if c not in COLUMNS]
    if set(attributes) <= set(details.columns) and star.codes_are_unique:
        scaled = _scaled(codes, details, tables).select(*COLUMNS, *attributes).withColumn("company", F.lit(codes.company))
        others = tag_company(pnl.union_all(_in_millions(codes, tables)), tables["peer_fact"], codes)
        rows = pnl.enrich(others, star.expense, star.department).unionByName(scaled)
        rows = rows.withColumn("value", F.col("value").cast(AMOUNT)) if is_decimal(rows, "value") else rows
    else:
        fact = tag_company(union_scaled(codes, details, tables), tables["peer_fact"], codes)
        rows = pnl.enrich(fact, star.expense, star.department)
    return rows.withColumn("value_type", pnl.classify(F.col("expense_type_5_id")))


def company_facts(codes: Codes, tables: Tables) -> DataFrame:
    """All facts of the company and its peer before any dimension: ``all_facts``, and the rows
    that are in millions already, whose entity is empty."""
    in_millions = [direct_ledger(tables, p.ledger) for p in parts(codes) if p.ledger is not None]
    in_millions.append(routed_eliminations(codes, tables))
    own = pnl.union_facts(in_millions, COLUMNS)
    millions = tag_company(own, tables["peer_fact"], codes).withColumn("entity", F.lit(""))
    entity_rows = all_facts(entities(codes), tables).withColumn("company", F.lit(codes.company))
    return entity_rows.unionByName(millions, allowMissingColumns=True)


def company_rows(codes: Codes, facts: DataFrame, tables: Tables, star: Star) -> DataFrame:
    """Rows of ``company_facts`` (or sums of them by month and codes) with their dimensions,
    routed to their entity, in the group's currency and in millions.

    A row is joined once: the codes it gets from its dimensions would find the same rows again.
    """
    rows = routed(entities(codes), pnl.enrich(facts, star.expense, star.department))
    named = [p.entity for p in parts(codes) if p.entity is not None]
    rows = converted(codes, rows.filter(F.col("entity").isin("", *named)), tables)
    given = F.col("given").cast(AMOUNT) if is_decimal(rows, "value") else F.col("given")
    rows = rescale(rows.withColumn("given", F.col("value")), "value", MILLIONTH)
    rows = rows.withColumn("value", F.when(F.col("entity") == "", given).otherwise(F.col("value"))).drop("given", "entity")
    return rows.withColumn("value_type", pnl.classify(F.col("expense_type_5_id")))


KEYS = ["source", "company"]
CONSOLIDATED_OUTPUT = (*OUTPUT[:13], "company", *OUTPUT[13:])


def month_sums(rows: DataFrame) -> DataFrame:
    """Month profit (every row, other income included) and month revenue."""
    return pnl.period_sums(rows, KEYS, pnl.consolidated_kinds())


def year_revenue(sums: DataFrame) -> DataFrame:
    return pnl.rollup_year(sums.filter(F.col("value_type") == pnl.TOTAL_REVENUE), KEYS)


def stacked(rows: DataFrame, sums: DataFrame) -> DataFrame:
    return pnl.stack_rows(pnl.label_units(rows), sums, EMPTY_TEXT)


def _reported(rows: DataFrame, summed: DataFrame) -> DataFrame:
    """Detail rows, their month subtotals, and on every row the revenue of its year."""
    sums = month_sums(summed)
    out = stacked(rows, pnl.with_previous(sums, KEYS, 1))
    return pnl.attach_revenue(out, year_revenue(sums), KEYS, "year").select(*CONSOLIDATED_OUTPUT)


def consolidate(codes: Codes, details: DataFrame, tables: Tables, star: Star) -> DataFrame:
    """The dataset from given detail rows of all entities, such as stored reports.

    Subtotals are taken of the same rows, or of facts added up before large dimensions
    (``entities.sum_rows``); the plan uses their exchange twice.
    """
    fact = tag_company(union_scaled(codes, details, tables), tables["peer_fact"], codes)

    def rows(of: DataFrame) -> DataFrame:
        return pnl.enrich(of, star.expense, star.department).withColumn("value_type", pnl.classify(F.col("expense_type_5_id")))

    return _reported(rows(fact), rows(fact if star.shuffles_once else pnl.month_facts(fact)))


def consolidated(codes: Codes, tables: Tables, star: Star) -> DataFrame:
    """The dataset from the conformed ledgers: no report is needed or written in between.

    Detail rows are streamed from one pass over all ledgers. A second pass takes subtotals of rows
    joined with broadcast dimensions; where the expense dimension is larger, both read one shuffle
    of the facts. Before a larger department dimension facts are added up by month and code, so that
    a hot code is a few rows in the joins' shuffles. Where a dimension holds a code twice, rows
    that pass through a report are doubled twice, so that is what happens here too.
    """
    if not star.codes_are_unique:
        return consolidate(codes, all_details(entities(codes), tables, star), tables, star)
    facts = company_facts(codes, tables)
    summed = facts if star.shuffles_once else pnl.month_facts(facts, ("value", FINANCIAL, MANAGEMENT))
    return _reported(company_rows(codes, facts, tables, star), company_rows(codes, summed, tables, star))
