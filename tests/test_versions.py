"""Rebuilt and reloaded tables: failures, readers, two writers, checks, layout, sweeps."""

import datetime as dt
import os
import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import checks
from ledgerloom.sources import tables as sinks
from ledgerloom.sources.contract import Contract, Mapping

ONE = Contract("d", None, (Mapping("k", "k", "int"),))
FACT = Contract("f", "d", (Mapping("d", "d", "timestamp"), Mapping("k", "k", "int")))


@pytest.fixture
def schema(spark, tmp_path):
    name = f"v_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def numbers(spark, n, start=0):
    return spark.range(start, start + n).select(F.col("id").cast("int").alias("k"), (F.col("id") % 3).cast("int").alias("p"))


def keys(df):
    return sorted(r["k"] for r in df.collect())


def folders(spark, schema, name):
    root = Path(sinks._versions_folder(spark, schema, name).removeprefix("file:"))
    return sorted(p for p in root.iterdir() if p.is_dir())


def test_a_failed_rebuild_leaves_rows_and_layout(spark, schema):
    table = f"{schema}.r"
    sinks.materialise(numbers(spark, 5), table, ("p",), ("k",))
    broken = numbers(spark, 9).withColumn("k", F.when(F.col("k") > 7, F.raise_error(F.lit("broken row"))).otherwise(1).cast("int"))
    with pytest.raises(Exception, match="broken row"):
        sinks.materialise(broken, table, ("p",), ("k",))
    assert keys(spark.table(table)) == [0, 1, 2, 3, 4] and len(folders(spark, schema, "r")) == 1
    plan = spark.table(table).filter("p = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
    assert [t.name for t in spark.catalog.listTables(schema) if t.name.startswith("_v_")] == [sinks.current_version(spark, table).split(".")[1]]


def test_a_rebuild_reads_the_table_itself(spark, schema):
    table = f"{schema}.r"
    for _ in range(2):
        sinks.materialise(numbers(spark, 6), table, ("p",))
    once = sinks.materialise(spark.table(table).filter("k > 1"), table, ("p",))
    assert keys(sinks.materialise(once.unionByName(once), table, ("k",))) == [2, 2, 3, 3, 4, 4, 5, 5]
    # other columns, no partitions, no rows
    other = sinks.materialise(spark.table(table).select(F.lit("x").alias("a b"), "k").filter("k > 9"), table)
    assert other.columns == ["a b", "k"] and other.count() == 0


def test_a_table_made_by_other_means_becomes_a_version(spark, schema):
    table = f"{schema}.old"
    numbers(spark, 3).write.saveAsTable(table)
    assert keys(sinks.materialise(spark.table(table).filter("k > 0"), table)) == [1, 2]


def test_readers_opened_before_a_reload_finish(spark, schema):
    table = sinks.ensure_table(spark, schema, ONE)
    sinks.replace_all(numbers(spark, 4), table)
    before = spark.table(table)
    before.schema
    sinks.replace_all(numbers(spark, 2, 10), table)
    assert keys(before) == [0, 1, 2, 3] and keys(spark.table(table)) == [10, 11]
    report = f"{schema}.r"
    sinks.materialise(numbers(spark, 4), report, ("p",))
    before = spark.table(report)
    sinks.materialise(numbers(spark, 1), report, ("p",))
    assert keys(before) == [0, 1, 2, 3] and keys(spark.table(report)) == [0]


def test_of_two_loads_one_is_refused(spark, schema):
    table = sinks.ensure_table(spark, schema, ONE)
    first, second = sinks.stage_all(numbers(spark, 1), table), sinks.stage_all(numbers(spark, 2), table)
    second.switch()
    with pytest.raises(sinks.LoadConflict, match="reloaded by another"):
        first.switch()
    assert keys(spark.table(table)) == [0, 1] and not os.path.exists(first.folder.removeprefix("file:"))

    fact = sinks.ensure_table(spark, schema, FACT, by_year=True)
    dated = lambda n: numbers(spark, n).withColumn("d", F.make_date(F.lit(2024), F.lit(1), F.lit(1)))
    first, second = sinks.stage_year(dated(1), fact, 2024, "d"), sinks.stage_year(dated(2), fact, 2024, "d")
    other = sinks.stage_year(dated(3), fact, 2023)
    first.switch()
    other.switch()  # of another year
    with pytest.raises(sinks.LoadConflict):
        second.switch()
    assert spark.table(fact).filter("load_year = 2024").count() == 1 and spark.table(fact).count() == 4

    report = f"{schema}.r"
    first, second = sinks.stage_table(numbers(spark, 1), report), sinks.stage_table(numbers(spark, 2), report)
    first.switch()
    with pytest.raises(sinks.LoadConflict):
        second.switch()
    assert keys(spark.table(report)) == [0] and len(folders(spark, schema, "r")) == 1


def test_a_switch_in_progress_refuses_others_until_it_is_stale(spark, schema, monkeypatch):
    table = sinks.ensure_table(spark, schema, ONE)
    staged = sinks.stage_all(numbers(spark, 1), table)
    with sinks._claim(spark, staged.root):
        with pytest.raises(sinks.LoadConflict, match="is switching"):
            sinks.stage_all(numbers(spark, 2), table).switch()
    sinks._touch(spark, f"{staged.root}/_claim")  # left by a load that died
    monkeypatch.setattr(sinks, "STALE_CLAIM", -1)
    staged.switch()
    assert keys(spark.table(table)) == [0]


def test_sweep_clears_what_was_replaced_long_ago(spark, schema):
    table, report = sinks.ensure_table(spark, schema, ONE), f"{schema}.r"
    fact = sinks.ensure_table(spark, schema, FACT, by_year=True)
    for n in (1, 2, 3):
        sinks.replace_all(numbers(spark, n), table)
        sinks.materialise(numbers(spark, n), report)
        for year in (2023, 2024):
            sinks.replace_year(numbers(spark, n).withColumn("d", F.make_date(F.lit(year), F.lit(1), F.lit(1))), fact, year)
    sinks.stage_table(numbers(spark, 9), report)  # given up
    assert sinks.sweep(spark, table) == sinks.sweep(spark, report) == sinks.sweep(spark, fact) == []
    time.sleep(0.01)
    assert [len(sinks.sweep(spark, t, hours=0)) for t in (table, report, fact)] == [2, 3, 4]
    assert keys(spark.table(table)) == keys(spark.table(report)) == [0, 1, 2] and spark.table(fact).count() == 6
    assert len([t for t in spark.catalog.listTables(schema) if t.name.startswith("_v_")]) == 1
    assert sinks.sweep(spark, table, hours=0) == [] and sinks.sweep(spark, f"{schema}.none") == []


def test_a_gate_keeps_the_old_rows(spark, schema):
    table = f"{schema}.r"
    gate = sinks.Gate(not_null=("k", "p"), unique=("k",))
    sinks.materialise(numbers(spark, 5), table, ("p",), gate=gate)
    assert sinks.stored_checks(spark, table) == {"check.rows": 5, "check.nulls.k": 0, "check.nulls.p": 0, "check.duplicates.k": 0}
    with pytest.raises(sinks.CheckFailed, match="'check.nulls.k': 2"):
        sinks.materialise(numbers(spark, 5).withColumn("k", F.when(F.col("k") > 1, F.col("k") - 2).when(F.col("k") < 0, 0)), table, gate=gate)
    with pytest.raises(sinks.CheckFailed, match="'check.duplicates.k': 5"):
        sinks.materialise(numbers(spark, 5).unionByName(numbers(spark, 5)), table, gate=gate)
    assert keys(spark.table(table)) == [0, 1, 2, 3, 4] and len(folders(spark, schema, "r")) == 1
    counts = checks.stored_null_counts(spark, {"r": (table, "k")}).collect()
    assert [tuple(r) for r in counts] == [("r", 0)]
    with pytest.raises(KeyError):
        checks.stored_null_counts(spark, {"r": (table, "other")})
    assert [tuple(r) for r in checks.stored_duplicates(spark, {"r": (table, "k")}).collect()] == [("r", 0)]


def test_files_of_bounded_number_and_skipped(spark, schema):
    """A file or two a folder however many tasks there were; large groups split by size."""
    rows = spark.range(0, 200_000, numPartitions=32).select(
        (F.col("id") % 2).cast("string").alias("source"), (F.col("id") % 18).cast("int").alias("kind"), F.xxhash64("id").alias("v")
    )
    def files(table):
        return [Path(f.removeprefix("file:")) for f in spark.table(table).inputFiles()]

    sinks.materialise(rows, f"{schema}.few", ("source",), ("kind",))
    assert len(files(f"{schema}.few")) <= 4
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        sinks.materialise(rows, f"{schema}.many", ("source",), ("kind",))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    found = files(f"{schema}.many")
    total = sum(f.stat().st_size for f in found)
    assert 2 < len(found) <= 4 * total // 65_536 + 18
    import pyarrow.parquet as pq

    def kinds(f):
        meta = pq.read_metadata(f)
        at = meta.schema.names.index("kind")
        return [(g.statistics.min, g.statistics.max) for g in (meta.row_group(k).column(at) for k in range(meta.num_row_groups))]

    holding = [f for f in found if any(a <= 7 <= b for a, b in kinds(f))]
    assert len(holding) < len(found) and spark.table(f"{schema}.many").filter("kind = 7").count() == sum(1 for i in range(200_000) if i % 18 == 7)


def test_many_tables_in_one_scan(spark, schema):
    rows = numbers(spark, 6).withColumn("s", F.when(F.col("k") > 4, None).when(F.col("k") > 2, "x:y z").otherwise("plain"))
    sinks.materialise(rows, f"{schema}.a", ("s", "p"))
    sinks.materialise(rows.filter("k < 3"), f"{schema}.a", ("s", "p"))  # old files are not read
    sinks.materialise(rows.filter("k > 2").select("k", "s", "p", F.lit("here").alias("extra")), f"{schema}.b", ("s", "p"))
    sinks.materialise(rows.filter("k > 9"), f"{schema}.empty", ("s", "p"))
    sinks.replace_all(numbers(spark, 2, 50), sinks.ensure_table(spark, schema, ONE))
    fact = sinks.ensure_table(spark, schema, FACT, by_year=True)
    for year in (2023, 2024):
        sinks.replace_year(numbers(spark, 1, year).withColumn("d", F.make_date(F.lit(year), F.lit(1), F.lit(1))), fact, year)
    named = {n: f"{schema}.{n}" for n in ("a", "b", "empty", "d", "f")}
    found, known = sinks.scan(spark, named, "k int, extra string")
    joined = found.join(known, "folder")
    assert sorted((r["dataset"], r["k"], r["extra"]) for r in joined.collect()) == [
        ("a", 0, None), ("a", 1, None), ("a", 2, None), ("b", 3, "here"), ("b", 4, "here"), ("b", 5, "here"),
        ("d", 50, None), ("d", 51, None), ("f", 2023, None), ("f", 2024, None),
    ]
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    found, known = sinks.scan(spark, {n: named[n] for n in ("a", "b")}, "k int", by=("s",), p=("0", "1"))
    got = sorted((r["dataset"], r["k"], r["s"]) for r in found.join(known, "folder").collect())
    assert got == [("a", 0, "plain"), ("a", 1, "plain"), ("b", 3, "x:y z"), ("b", 4, "x:y z")]
    assert {r["s"] for r in sinks.scan(spark, {"b": named["b"]}, "k int", by=("s",), p=("2",))[1].collect()} == {None}
    with pytest.raises(ValueError, match="no table"):
        sinks.scan(spark, {"empty": named["empty"]}, "k int")


def test_relationships_of_stored_facts(spark, schema):
    rows = spark.createDataFrame([("E1", "D1"), ("E1", "D9"), ("E9", "D9"), (None, "D1")], "expense_code string, department_code string")
    sinks.materialise(rows, f"{schema}.main")
    sinks.materialise(rows.select(F.lit(dt.date(2024, 1, 1)).alias("date"), "department_code"), f"{schema}.rate", ("date",))
    dims = {"dim_department": rows.filter("department_code = 'D1'"), "dim_expense_type": rows.filter("expense_code = 'E1'")}
    declared = {"main": ("expense_code", "department_code"), "rate": ("department_code",)}
    got = checks.stored_relationship_violations(spark, {n: f"{schema}.{n}" for n in declared}, dims, declared)
    expected = [("main", "department_code", "D9", 2), ("main", "expense_code", "E9", 1), ("rate", "department_code", "D9", 2)]
    assert sorted(tuple(r) for r in got.select("dataset", "key_column", "key", "n").collect()) == expected


def dated(spark, *years):
    days = spark.createDataFrame([(dt.date(y, 3, 1) if y else None, k) for k, y in enumerate(years)], "d date, k int")
    return days.repartition(3)


def test_all_years_by_one_job(spark, schema):
    fact = sinks.ensure_table(spark, schema, FACT, by_year=True)
    counted = lambda: sorted((r["load_year"], r["count"]) for r in spark.table(fact).groupBy("load_year").count().collect())
    assert sinks.replace_years(dated(spark, 2022, 2023, 2023, 2024, None), fact, "d") == [2022, 2023, 2024]
    assert counted() == [(2022, 1), (2023, 2), (2024, 1)]
    assert sinks.replace_years(dated(spark, 2023, 2025), fact, "d") == [2023, 2025]
    assert counted() == [(2022, 1), (2023, 1), (2024, 1), (2025, 1)]
    assert sinks.replace_years(dated(spark), fact, "d") == []
    sinks.replace_year(dated(spark, 2022, 2022, 2022), fact, 2022, "d")
    assert sinks.sweep(spark, fact) == []
    cleared = sinks.sweep(spark, fact, hours=0)
    assert sorted(c.rpartition("/")[2] for c in cleared if "=" in c) == ["load_year=2022", "load_year=2023"]
    assert counted() == [(2022, 3), (2023, 1), (2024, 1), (2025, 1)]


def test_a_refused_year_gives_up_the_later_ones(spark, schema):
    fact = sinks.ensure_table(spark, schema, FACT, by_year=True)
    staged = sinks.stage_years(dated(spark, 2022, 2023, 2024), fact, "d")
    sinks.replace_year(dated(spark, 2023, 2023), fact, 2023)
    staged[0].switch()
    with pytest.raises(sinks.LoadConflict):
        staged[1].switch()
    staged[2].switch()
    assert sorted((r["load_year"], r["count"]) for r in spark.table(fact).groupBy("load_year").count().collect()) == [(2022, 1), (2023, 2), (2024, 1)]
    broken = dated(spark, 2022).withColumn("k", F.when(F.col("k") >= 0, F.raise_error(F.lit("broken cell"))).cast("int"))
    with pytest.raises(Exception, match="broken cell"):
        sinks.replace_years(broken, fact, "d")
    assert spark.table(fact).count() == 4
