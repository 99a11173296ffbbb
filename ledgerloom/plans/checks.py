"""The declared data checks: 7 unique keys, 70 relationships, 20 dates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.lookup import Lookup
from ledgerloom.operators.pnl import union_all
from ledgerloom.operators.quality import duplicates
from ledgerloom.plans.silver import FACTS
from ledgerloom.sources.tables import scan, stored_checks

UNIQUE: dict[str, str] = {
    "dim_ob": "ob_id",
    "dim_expense_type": "expense_code",
    "dim_expense_type_2": "expense_type_id",
    "dim_expense_type_3": "expense_type_id",
    "dim_expense_type_4": "expense_type_id",
    "dim_expense_type_5": "expense_type_id",
    "dim_revenue": "revenue_id",
}

# Every fact key has to be found in its dimension.
KEY_DIMS = {"department_code": "dim_department", "expense_code": "dim_expense_type"}
RELATIONSHIPS: dict[str, tuple[str, ...]] = {name: spec.keys for name, spec in FACTS.items()}

# Conformed facts with a declared date; every report and allocation dataset has one too.
NOT_NULL: dict[str, str] = {
    "education_ledger": "accounting_date",
    "education_ledger_planning": "accounting_date",
    "main_adjustment": "accounting_date",
    "main_adjustment_planning": "accounting_date",
}
REPORT_DATE = "date"


def unique_violations(tables: Mapping[str, DataFrame], checks: Mapping[str, str]) -> DataFrame:
    """``dataset``, ``key`` (as text) and ``n`` for every key found more than once."""
    found = [
        duplicates(tables[name], key).select(F.lit(name).alias("dataset"), F.col(key).cast("string").alias("key"), "n")
        for name, key in checks.items()
    ]
    return union_all(found)


def relationship_violations(
    tables: Mapping[str, DataFrame], checks: Mapping[str, tuple[str, ...]] = RELATIONSHIPS
) -> DataFrame:
    """``dataset``, ``key_column``, ``key`` and ``n`` for every fact key its dimension lacks.

    All facts are read once and their keys counted in one aggregation, so each key
    reaches the anti join as a single row however many facts hold it.
    """
    pairs = [
        tables[name].select(
            F.lit(name).alias("dataset"),
            F.explode(F.array(*[F.struct(F.lit(k).alias("key_column"), F.col(k).alias("key")) for k in keys])).alias("k"),
        )
        for name, keys in checks.items()
    ]
    counts = (
        union_all(pairs)
        .select("dataset", "k.key_column", "k.key")
        .filter(F.col("key").isNotNull())
        .groupBy("dataset", "key_column", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _unknown(counts, tables)


def stored_relationship_violations(
    spark: SparkSession, stored: Mapping[str, str], dims: Mapping[str, DataFrame], checks: Mapping[str, tuple[str, ...]] = RELATIONSHIPS
) -> DataFrame:
    """The same for stored facts (dataset to table), all files in one scan of their key columns.

    Keys are counted by folder, and only those counts are told which dataset a folder is of.
    """
    columns = sorted({k for name in stored for k in checks[name]})
    rows, known = scan(spark, stored, ", ".join(f"{c} string" for c in columns))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("key_column"), F.col(c).alias("key")) for c in columns]))
    counts = rows.select("folder", pairs.alias("k")).select("folder", "k.*").filter(F.col("key").isNotNull())
    counts = counts.groupBy("folder", "key_column", "key").agg(F.count(F.lit(1)).alias("n"))
    declared = [(name, c) for name in stored for c in checks[name]]
    known = known.join(spark.createDataFrame(declared, "dataset string, key_column string"), "dataset")
    counts = counts.join(F.broadcast(known), ["folder", "key_column"])  # a row a folder and column
    return _unknown(counts.groupBy("dataset", "key_column", "key").agg(F.sum("n").alias("n")), dims)


def _unknown(counts: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    known = union_all(
        tables[dim].select(F.lit(key).alias("key_column"), F.col(key).alias("key")) for key, dim in KEY_DIMS.items()
    )
    lookup = Lookup(known)
    return counts.join(F.broadcast(known) if lookup.is_small else known, ["key_column", "key"], "left_anti")


def null_counts(datasets: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``dataset`` and the number of its rows without a value in the declared column.

    Those rows are filtered, not told apart in the count: the planner moves a filter down to the
    facts a dataset is made of, so that rows with a value are not joined and added up first.
    """
    counts = [
        df.filter(F.col(column).isNull()).agg(F.count(F.lit(1)).alias("nulls")).select(F.lit(name).alias("dataset"), "nulls")
        for name, (df, column) in datasets.items()
    ]
    return union_all(counts)


def stored_null_counts(spark: SparkSession, datasets: Mapping[str, tuple[str, str]]) -> DataFrame:
    """The same for rebuilt tables (name, column), from what was counted as they were written:
    no data is read. A column that no gate counted is a KeyError."""
    return _stored(spark, datasets, "check.nulls.", "nulls")


def stored_duplicates(spark: SparkSession, datasets: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``dataset`` and its number of keys found more than once, as counted at the gate."""
    return _stored(spark, datasets, "check.duplicates.", "duplicates")


def _stored(spark: SparkSession, datasets: Mapping[str, tuple[str, str]], prefix: str, name: str) -> DataFrame:
    counts = [(dataset, stored_checks(spark, table)[prefix + column]) for dataset, (table, column) in datasets.items()]
    return spark.createDataFrame(counts, f"dataset string, {name} long")
