"""The ten plan-versus-actual datasets, one spec each."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import MILLION, rescale
from ledgerloom.operators import pnl
from ledgerloom.operators.currency import fx_divide, rate_lookup
from ledgerloom.operators.lookup import Lookup
from ledgerloom.operators.pnl import KeyCase
from ledgerloom.plans.star import Star, Tables
from ledgerloom.sources.load import slice_year
from ledgerloom.sources.workspace import materialised

FINANCIAL, MANAGEMENT = "financial_report_value", "management_report_value"


@dataclass(frozen=True)
class Codes:
    """The codes a company uses for its blocks, departments and entry types."""

    apac_block: str
    solutions_block: str
    vietnam_block: str
    group_block: str
    regional_block: str
    # the parent's department whose ledger belongs to Japan, and names Japan's rates
    japan_department: str
    # the one year in which that ledger is taken over
    japan_takeover_year: int
    japan_allocation_department: str
    korea_department: str
    # the department whose shared detail is carved out of the Vietnam block
    shared_detail_department: str
    outsourcing_elimination: str
    it_elimination: str
    group_elimination: str
    company: str
    peer_company: str


@dataclass(frozen=True)
class Branch:
    """A ledger that feeds a dataset, whole or narrowed and converted."""

    table: str
    department: str | None = None
    year: int | None = None
    rate_department: str | None = None


@dataclass(frozen=True)
class Detail:
    """Shared detail in millions, added to (or taken from) a block's own rows."""

    actual: str
    planning: str
    department: str | None = None
    subtract: bool = False


@dataclass(frozen=True)
class EntitySpec:
    name: str
    actual: tuple[Branch, ...]
    planning: tuple[Branch, ...]
    measure: str
    key_case: KeyCase = "upper"
    block: str | None = None
    flip_planned: bool = False
    detail: Detail | None = None
    grain: Literal["month", "department_year"] = "month"
    missing_revenue: int | None = None
    plain_unit_ids: tuple[int, ...] = (0,)


def _branches(*tables: str) -> tuple[Branch, ...]:
    return tuple(Branch(t) for t in tables)


_MAIN_ACTUAL = _branches("main_ledger", "main_adjustment")
_MAIN_PLANNING = _branches("main_ledger_planning", "main_adjustment_planning")
_SOLUTIONS_DETAIL = ("solutions_detail", "solutions_detail_planning")


def entities(codes: Codes) -> dict[str, EntitySpec]:
    japan_takeover = Branch(
        "main_ledger", codes.japan_department, codes.japan_takeover_year, rate_department=codes.japan_department
    )

    def by_department(name: str, block: str) -> EntitySpec:
        return EntitySpec(
            name,
            _MAIN_ACTUAL,
            _MAIN_PLANNING,
            FINANCIAL,
            key_case="lower",
            block=block,
            grain="department_year",
            plain_unit_ids=(0, 2),
        )

    specs = [
        EntitySpec("apac", _MAIN_ACTUAL, _MAIN_PLANNING, FINANCIAL, block=codes.apac_block),
        EntitySpec("education", _branches("education_ledger"), _branches("education_ledger_planning"), MANAGEMENT),
        EntitySpec(
            "it_services",
            _branches("it_services_ledger", "it_services_exclusion", "it_services_overseas_ledger"),
            _branches("it_services_ledger_planning", "it_services_revenue_planning"),
            MANAGEMENT,
            key_case="raw",
            flip_planned=True,
        ),
        EntitySpec(
            "solutions",
            _MAIN_ACTUAL,
            _MAIN_PLANNING,
            MANAGEMENT,
            block=codes.solutions_block,
            detail=Detail(*_SOLUTIONS_DETAIL),
        ),
        EntitySpec(
            "training",
            _branches("training_ledger", "training_adjustment"),
            _branches("training_ledger_planning"),
            MANAGEMENT,
            missing_revenue=0,
        ),
        EntitySpec(
            "japan",
            (
                Branch("japan_ledger"),
                japan_takeover,
                Branch("japan_allocation", codes.japan_allocation_department),
                Branch("japan_adjustment"),
            ),
            _branches("japan_ledger_planning", "japan_adjustment_planning", "japan_revenue_planning"),
            FINANCIAL,
        ),
        EntitySpec(
            "korea",
            _branches("korea_ledger", "korea_adjustment"),
            _branches("korea_ledger_planning", "korea_adjustment_planning", "korea_revenue_planning"),
            MANAGEMENT,
            flip_planned=True,
        ),
        EntitySpec(
            "vietnam",
            _MAIN_ACTUAL,
            _MAIN_PLANNING,
            MANAGEMENT,
            block=codes.vietnam_block,
            detail=Detail(*_SOLUTIONS_DETAIL, department=codes.shared_detail_department, subtract=True),
        ),
        by_department("group", codes.group_block),
        by_department("regional", codes.regional_block),
    ]
    return {s.name: s for s in specs}


_FACT_COLUMNS = ("date", "value", "department_code", "expense_code")


def branch_rows(branch: Branch, measure: str, tables: Tables) -> DataFrame:
    rows = tables[branch.table]
    if branch.department is not None:
        rows = rows.filter(F.col("department_code") == branch.department)
    if branch.year is not None:
        rows = slice_year(rows, "accounting_date", branch.year)
    rows = rows.selectExpr("accounting_date AS date", f"{measure} AS value", "department_code", "expense_code")
    if branch.rate_department is not None:
        rows = fx_divide(rows, rate_lookup(tables["exchange_rate"], branch.rate_department), "date", "value")
    return rows


def fact_rows(spec: EntitySpec, tables: Tables) -> DataFrame:
    actual, planning = (
        pnl.union_facts([branch_rows(b, spec.measure, tables) for b in branches], _FACT_COLUMNS)
        for branches in (spec.actual, spec.planning)
    )
    return pnl.tag_source(actual, planning)


def detail_rows(detail: Detail, measure: str, tables: Tables) -> DataFrame:
    rows = pnl.tag_source(
        *[
            pnl.union_facts([branch_rows(Branch(table), measure, tables)], _FACT_COLUMNS)
            for table in (detail.actual, detail.planning)
        ]
    )
    if detail.department is not None:
        rows = rows.filter(F.upper("department_code") == detail.department)
    return rescale(rows, "value", -MILLION if detail.subtract else MILLION)


def pnl_rows(spec: EntitySpec, tables: Tables, star: Star, by_month: bool = False) -> DataFrame:
    """Enriched, classified detail rows of one dataset (or, ``by_month``, their month sums)."""

    def enriched(fact: DataFrame, block: str | None = None) -> DataFrame:
        if by_month:
            fact = pnl.month_facts(fact)
        return pnl.enrich(fact, star.expense, star.department, spec.key_case, block)

    rows = enriched(fact_rows(spec, tables), spec.block)
    if spec.detail is not None:
        # The shared detail is not filtered by block.
        rows = rows.unionByName(enriched(detail_rows(spec.detail, spec.measure, tables)))
    kind = F.col("expense_type_5_id")
    if spec.flip_planned:
        rows = rows.withColumn("value", pnl.flip_planned_cost(F.col("value"), kind, F.col("source")))
    return rows.withColumn("value_type", pnl.classify(kind))


def sum_rows(spec: EntitySpec, tables: Tables, star: Star, rows: DataFrame) -> DataFrame:
    """The rows to take subtotals of.

    Broadcast dimensions shuffle nothing, so the detail rows do. They also do where one shuffle
    serves them and their sums. Otherwise the facts to be joined are added up first; a hot code
    becomes a few rows.
    """
    shared = star.is_small or (star.shuffles_once and spec.grain == "month")
    return rows if shared else pnl_rows(spec, tables, star, by_month=True)


def subtotals(spec: EntitySpec, rows: DataFrame) -> DataFrame:
    """Subtotal rows with the previous period's value.

    By department, profits are yearly with costs negative, revenue stays monthly, and
    all are compared to the year before.
    """
    if spec.grain == "month":
        return pnl.with_previous(pnl.period_sums(rows, ["source"], pnl.monthly_kinds()), ["source"], 1)
    # One block is selected, so the block code never splits a department's periods.
    keys = ["source", "department_code", "ob_code"]
    profits = (pnl.PROFIT, pnl.NET_PROFIT)
    months = pnl.period_sums(rows, keys, pnl.monthly_kinds(), signed=profits)
    return pnl.with_previous(pnl.rollup_year(months, keys, profits), keys, 12)


DETAIL_COLUMNS = ("date", "value", "expense_code", "department_code", "source")


def all_facts(specs: dict[str, EntitySpec], tables: Tables) -> DataFrame:
    """The facts of every dataset, with the ``entity`` they belong to, before any dimension.

    The parent's ledgers feed all blocks. They are read once, with both measures and without
    an entity, which ``routed`` then takes from a row's block.
    """
    shared = pnl.tag_source(
        *[
            pnl.union_facts([_measures(tables[b.table]) for b in branches], _MEASURES)
            for branches in (_MAIN_ACTUAL, _MAIN_PLANNING)
        ]
    ).withColumn("entity", F.lit(None).cast("string"))
    own = [
        fact_rows(s, tables).withColumn("entity", F.lit(s.name)) for s in specs.values() if s.block is None
    ] + [
        detail_rows(s.detail, s.measure, tables).withColumn("entity", F.lit(s.name))
        for s in specs.values()
        if s.detail is not None
    ]
    return pnl.union_all([shared, *own], missing=True)


def routed(specs: dict[str, EntitySpec], rows: DataFrame) -> DataFrame:
    """Enriched rows of ``all_facts`` with their entity and its measure; others are dropped."""
    blocks = {s.block: s for s in specs.values() if s.block is not None}
    if len(blocks) < sum(s.block is not None for s in specs.values()):
        raise ValueError("two entities have one block code")
    entity, value = F.col("entity"), F.col("value")
    for block, spec in blocks.items():
        in_block = F.col("entity").isNull() & (F.col("ob_code") == block)
        entity = F.when(in_block, F.lit(spec.name)).otherwise(entity)
        value = F.when(in_block, F.col(spec.measure)).otherwise(value)
    rows = rows.withColumns({"entity": entity, "value": value}).filter(F.col("entity").isNotNull())
    flipped = [s.name for s in specs.values() if s.flip_planned]
    turned = pnl.flip_planned_cost(F.col("value"), F.col("expense_type_5_id"), F.col("source"))
    value = F.when(F.col("entity").isin(*flipped), turned).otherwise(F.col("value"))
    return rows.withColumn("value", value).drop(FINANCIAL, MANAGEMENT)


def all_details(specs: dict[str, EntitySpec], tables: Tables, star: Star) -> DataFrame:
    """``DETAIL_COLUMNS`` and ``entity`` of every dataset's detail rows, in one pass.

    All ledgers are united before the dimension joins, which compare conformed keys, so
    upper and lower case make no difference.
    """
    return all_rows(specs, tables, star).select("entity", *DETAIL_COLUMNS)


def all_rows(specs: dict[str, EntitySpec], tables: Tables, star: Star) -> DataFrame:
    """The rows of ``all_details`` with the columns of their dimensions."""
    return routed(specs, pnl.enrich(all_facts(specs, tables), star.expense, star.department))


_MEASURES = ("date", FINANCIAL, MANAGEMENT, "department_code", "expense_code")


def _measures(ledger: DataFrame) -> DataFrame:
    return ledger.withColumnRenamed("accounting_date", "date").select(*_MEASURES)


OUTPUT = (
    "date",
    "value",
    "value_type",
    "expense_code",
    "expense_type_5_id",
    "expense_type_5_name",
    "department_code",
    "business_unit_1_id",
    "business_unit_1_name",
    "business_unit_2_id",
    "business_unit_2_name",
    "business_unit_3_name",
    "ob_code",
    "source",
    "previous_value",
    "str_value",
)
OUTPUT_BY_DEPARTMENT = (*OUTPUT[:11], "business_unit_3_id", *OUTPUT[11:])

EMPTY_TEXT = ("expense_type_5_name", "business_unit_1_name", "business_unit_2_name", "business_unit_3_name", "ob_code")


def stacked(spec: EntitySpec, rows: DataFrame, sums: DataFrame) -> DataFrame:
    empty = EMPTY_TEXT if spec.grain == "month" else (*EMPTY_TEXT, "expense_code")
    return pnl.stack_rows(pnl.label_units(rows, spec.plain_unit_ids), sums, empty)


def plan_actual(spec: EntitySpec, tables: Tables, star: Star, yearly_revenue: bool = False) -> DataFrame:
    """The dataset: detail rows, subtotal rows, and on every row the revenue of its period.

    By department, a row's year start is looked up among the *months* of revenue, so
    only January's revenue is ever found; ``yearly_revenue`` attaches the year's instead.
    """
    rows = pnl_rows(spec, tables, star)
    sums = subtotals(spec, sum_rows(spec, tables, star, rows))
    if spec.grain == "month":
        revenue = sums.filter(F.col("value_type") == pnl.TOTAL_REVENUE)
        out = pnl.attach_revenue(stacked(spec, rows, sums), revenue, ["source"], default=spec.missing_revenue, one_a_period=True)
        return out.select(*OUTPUT)
    # Grows with the departments, so it is computed once, counted, and then used twice.
    sums = materialised(sums)
    revenue = sums.filter(F.col("value_type") == pnl.TOTAL_REVENUE)
    keys = ["source", "department_code"]
    if yearly_revenue:
        revenue = pnl.rollup_year(revenue, keys)
    else:
        revenue = revenue.filter(F.month("date") == 1)
    out = pnl.attach_revenue(stacked(spec, rows, sums), Lookup(revenue), keys, "year")
    return out.select(*OUTPUT_BY_DEPARTMENT)
