"""Step-down allocation: support, back office, shared services, overhead."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import MILLIONTH, rescale
from ledgerloom.operators import allocation as a
from ledgerloom.operators.lookup import Lookup, lookup_join
from ledgerloom.operators.pnl import union_facts
from ledgerloom.plans.star import Tables
from ledgerloom.sources.workspace import materialised


@dataclass(frozen=True)
class Service:
    """A shared-service department whose cost is handed on by effort."""

    department: str
    effort_table: str
    fold_case: bool

    def is_pool(self, department: Column) -> Column:
        return (F.upper(department) if self.fold_case else department) == self.department


@dataclass(frozen=True)
class AllocationCodes:
    comtor: Service
    qa: Service
    # departments (as written in the man-month table) left out of the back-office total
    base_excluded: tuple[str, ...]
    # departments (upper case) that carry no overhead, besides the two services
    overhead_excluded: tuple[str, ...]
    base_blocks: tuple[str, ...]
    block: str
    # Fee class of expenses, type of regular man-months, unit ids.
    expense_class: str = "Chi phí"
    man_month_type: str = "MM001"
    support_pool_unit: int = 5
    support_units: tuple[int, ...] = (1, 13, 14)
    bo_pool_unit: int = 7
    bo_units: tuple[int, ...] = (1, 13, 14, 2, 3, 11)


def department_units(tables: Tables) -> DataFrame:
    department = tables["dim_department"].select("department_code", "unit_id", "ob_id")
    ob = tables["dim_ob"].select("ob_id", "ob_code")
    return department.join(ob, "ob_id", "left").select("department_code", "unit_id", "ob_code")


@dataclass
class StepDown:
    """The five allocation datasets over one set of inputs.

    Tables read: dim_feecode, allocation_ledger, allocation_adjustment, man_month and the
    effort tables as loaded, dim_department and dim_ob as conformed.
    """

    tables: Tables
    codes: AllocationCodes

    @cached_property
    def fee_codes(self) -> Lookup:
        return Lookup(
            self.tables["dim_feecode"].select(
                F.col("code").alias("fee_key"), "fee_type_1", "fee_type_2", "fee_type_3", "fee_type_4", "type_id"
            )
        )

    @cached_property
    def departments(self) -> Lookup:
        return Lookup(department_units(self.tables).withColumnRenamed("department_code", "department_key"))

    def _with_department(self, df: DataFrame) -> DataFrame:
        on = [(F.upper("department_code"), F.upper("department_key"))]
        return lookup_join(df, self.departments, on).drop("department_key")

    def scaled_ledger(self) -> DataFrame:
        columns = [
            F.col("accounting_date").alias("date"),
            F.col("bctc").alias("financial_report_value"),
            F.col("bcqt").alias("management_report_value"),
            F.col("fee_code").alias("expense_code"),
            F.col("department_id").alias("department_code"),
            F.col("gl3_code"),
        ]
        names = [self.tables[t].select(*columns) for t in ("allocation_ledger", "allocation_adjustment")]
        rows = union_facts(names, names[0].columns)
        for measure in ("financial_report_value", "management_report_value"):
            rows = rescale(rows, measure, MILLIONTH)
        return rows

    def ledger(self) -> DataFrame:
        rows = lookup_join(self.scaled_ledger(), self.fee_codes, [(F.upper("expense_code"), F.upper("fee_key"))])
        return self._with_department(rows.drop("fee_key"))

    def man_months_joined(self) -> DataFrame:
        rows = self.tables["man_month"].select(
            F.col("accounting_date").alias("date"), "value", "type_id", F.col("department_id").alias("department_code")
        )
        return self._with_department(rows)

    def expense_by_department(self) -> DataFrame:
        costs = self.ledger().filter(F.col("fee_type_3") == self.codes.expense_class)
        return costs.groupBy("date", "ob_code", "unit_id", "department_code").agg(
            F.sum("management_report_value").alias("value")
        )

    def man_month_by_department(self) -> DataFrame:
        keys = ("date", "type_id", "ob_code", "unit_id", "department_code")
        return self.man_months_joined().groupBy(*keys).agg(F.sum("value").alias("value"))

    # Every step below reads these two; the ledger and the man-months are scanned once.
    @cached_property
    def expense(self) -> DataFrame:
        return materialised(self.expense_by_department())

    @cached_property
    def man_month(self) -> DataFrame:
        return materialised(self.man_month_by_department())

    @cached_property
    def regular(self) -> DataFrame:
        return self.man_month.filter(F.col("type_id") == self.codes.man_month_type)

    def support_pool(self) -> DataFrame:
        return self.expense.filter(F.col("unit_id") == self.codes.support_pool_unit)

    def support_base(self) -> DataFrame:
        base = self.regular.filter(
            (F.col("ob_code") == self.codes.block) & F.col("unit_id").isin(*self.codes.support_units)
        )
        return a.with_total(base, "value", "calendar_mm_total")

    def support(self) -> DataFrame:
        """Each support department's cost to each base department, one row per pair and date."""
        base = self.support_base().select(
            "date", "unit_id", "department_code", F.col("value").alias("calendar_mm"), "calendar_mm_total"
        )
        pool = self.support_pool().select(
            "date", F.col("department_code").alias("department_distribute_code"), F.col("value").alias("expense")
        )
        return a.allocate_full(base, pool).select(
            "date",
            "unit_id",
            "department_distribute_code",
            "department_code",
            "expense",
            "calendar_mm",
            "calendar_mm_total",
            a.share(F.col("calendar_mm"), F.col("expense"), F.col("calendar_mm_total")).alias("distribution"),
        )

    def support_received(self) -> DataFrame:
        """Support by date and receiving department, from pool sums instead of pairs."""
        pool = a.sum_by_date(self.support_pool(), "value", "expense")
        rows = a.join_by_date(self.support_base(), pool)
        return rows.select(
            "date",
            "department_code",
            a.share(F.col("value"), F.col("expense"), F.col("calendar_mm_total")).alias("distribution"),
        )

    def support_by_department(self) -> DataFrame:
        """What each department received, and one row for cost no base department could take."""
        received = self.support_received()
        dates = self.support_base().select("date").distinct()
        alone = self.support_pool().select("date").join(F.broadcast(dates), "date", "left_anti")
        nobody = alone.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in received.schema])
        rows = received.unionByName(nobody).groupBy("date", "department_code")
        return rows.agg(F.sum("distribution").alias("distribution"))

    def bo_pool(self) -> DataFrame:
        pool = self.expense.filter(
            (F.col("unit_id") == self.codes.bo_pool_unit) & (F.col("ob_code") == self.codes.block)
        )
        return a.sum_by_date(pool, "value", "expense")

    def bo_total(self) -> DataFrame:
        """The denominator; a row without a department is left out too, as NOT IN does."""
        base = self.regular.filter(
            F.col("ob_code").isin(*self.codes.base_blocks)
            & ~F.col("department_code").isin(*self.codes.base_excluded)
        )
        return a.sum_by_date(base, "value", "calendar_mm_total")

    def bo(self) -> DataFrame:
        """Back-office cost; the total counts more units than receive, so shares stay below the pool."""
        base = self.regular.filter((F.col("ob_code") == self.codes.block) & F.col("unit_id").isin(*self.codes.bo_units))
        rows = a.join_by_date(a.join_by_date(base, self.bo_total()), self.bo_pool())
        return rows.select(
            "date",
            "unit_id",
            "department_code",
            "expense",
            F.col("value").alias("calendar_mm"),
            "calendar_mm_total",
            a.share(F.col("value"), F.col("expense"), F.col("calendar_mm_total")).alias("distribution"),
        )

    @cached_property
    def services(self) -> tuple[Service, Service]:
        return self.codes.comtor, self.codes.qa

    @cached_property
    def service_pools(self) -> DataFrame:
        """Each service's own expense with the support and back-office cost it received, by date.

        Both services come from one aggregation and are written, so that a dataset of both
        distributes support and back office once. A department can belong to both.
        """
        own = self.expense.select("date", "department_code", a.ratio(F.col("value")).alias("value"))
        received = [
            df.select("date", "department_code", F.col("distribution").alias("value"))
            for df in (self.support_received(), self.bo())
        ]
        matched = [F.when(s.is_pool(F.col("department_code")), k) for k, s in enumerate(self.services)]
        rows = reduce(DataFrame.unionByName, [own, *received])
        rows = rows.select("date", F.explode(F.array_compact(F.array(*matched))).alias("service"), "value")
        return materialised(rows.groupBy("service", "date").agg(F.sum("value").alias("expense_value")))

    def service_pool(self, service: Service) -> DataFrame:
        """The pool of one of the two services by date."""
        own = F.col("service") == self.services.index(service)
        return self.service_pools.filter(own).select("date", "expense_value")

    def effort(self, service: Service) -> DataFrame:
        """Effort rows with the service's cost and man-months of their date.

        A service spelt in two ways has two man-month rows on a date and doubles its
        effort rows, as the join does.
        """
        rows = self.tables[service.effort_table].select(
            F.col("accounting_date").alias("date"), F.col("department_id").alias("department_code"), "effort"
        )
        own = self.regular.filter(service.is_pool(F.col("department_code"))).select(
            F.col("date").alias("mm_date"), F.col("value").alias("man_month_value")
        )
        rows = a.join_by_date(rows, self.service_pool(service))
        return lookup_join(rows, Lookup(own), [(F.col("date"), F.col("mm_date"))]).drop("mm_date")

    def service(self, service: Service) -> DataFrame:
        return a.allocate_effort(self.effort(service), service.is_pool(F.col("department_code")))

    def comtor(self) -> DataFrame:
        return self.service(self.codes.comtor)

    def qa(self) -> DataFrame:
        return self.service(self.codes.qa)

    def _carries_overhead(self) -> Column:
        excluded = (*self.codes.overhead_excluded, self.codes.comtor.department.upper(), self.codes.qa.department.upper())
        return F.col("ob_code").isin(*self.codes.base_blocks) & ~F.upper("department_code").isin(*excluded)

    def overhead_base(self) -> DataFrame:
        """All regular man-months with the date's total over overhead-carrying departments."""
        return a.with_total(self.regular, "value", "calendar_mm_total", self._carries_overhead())

    def overhead(self) -> DataFrame:
        """Unused service cost spread by man-months.

        The man-month rows are unique by the report's keys, so the two services' overhead
        is added up by date and no second grouping is needed.
        """
        pools = reduce(
            DataFrame.unionByName,
            [df.filter(F.col("department_code") == a.OVERHEAD) for df in (self.comtor(), self.qa())],
        )
        pool = a.sum_by_date(pools, "distribution_regular", "expense")
        base = self.overhead_base().filter(self._carries_overhead())
        rows = a.join_by_date(base, pool, "inner")
        return rows.select(
            "date",
            "unit_id",
            "ob_code",
            "department_code",
            "expense",
            F.col("value").alias("calendar_mm"),
            "calendar_mm_total",
            a.share(F.col("value"), F.col("expense"), F.col("calendar_mm_total")).alias("distribution"),
        )

    # The order each dataset is written in.
    ORDER = {
        "support": ("date", "unit_id", "department_code"),
        "bo": ("date", "unit_id", "department_code"),
        "comtor": ("date", "department_code"),
        "qa": ("date", "department_code"),
        "overhead": ("date", "department_code"),
    }

    def dataset(self, name: str) -> DataFrame:
        """One of the five datasets, in its order."""
        return a.ordered(getattr(self, name)(), *self.ORDER[name])
