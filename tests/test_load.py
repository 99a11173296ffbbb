"""Contracts, coercion and table sinks."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.dates import to_date_lenient
from ledgerloom.functions.numbers import to_float, to_int, to_long
from ledgerloom.functions.text import blank_to_null
from ledgerloom.sources import load as steps
from ledgerloom.sources import tables as sinks
from ledgerloom.sources.contract import Contract, ContractError, Mapping
from ledgerloom.sources.workspace import fresh_folder, intermediates, materialised

CELLS = "row int, a string, b string, c string"


def column(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_numbers(spark):
    texts = ["12.5", " 7 ", "-1e3", "1d", "0x1p3", "nan", "n/a", "", None, "inf", "12,5", "3000000000"]
    assert column(spark, texts, to_float) == [
        12.5, 7.0, -1000.0, None, None, None, None, None, None, float("inf"), None, 3e9,
    ]
    assert column(spark, ["12.5", "12.4", "-2.5", "x", "3000000000", "1e2"], to_int) == [13, 12, -3, None, None, 100]


def test_contract(spark):
    cells = [
        (1, None, " Fact_X ", None),
        (2, None, " Booked ", None),
        (6, "col_name_excel", "col_name_des", "type_of_col_des"),
        (7, " Code ", "CODE", "varchar"),
        (8, "When", "booked", "Timestamp"),
        (9, "left out", None, "int"),
    ]
    c = Contract.from_cells(spark.createDataFrame(cells, CELLS))
    assert (c.table, c.time_column) == ("fact_x", "booked")
    assert c.mappings == (Mapping("code", "code", "varchar"), Mapping("when", "booked", "Timestamp"))
    assert c.schema.simpleString() == "struct<code:string,booked:date>"
    dim = Contract.from_cells(spark.createDataFrame(cells, CELLS), fold_case=False)
    assert dim.mappings[0] == Mapping(" Code ", "CODE", "varchar")
    with pytest.raises(ContractError, match="names no table"):
        Contract.from_cells(spark.createDataFrame(cells[1:], CELLS))


def test_date_formats(spark):
    df = spark.createDataFrame(
        [("1/2/2024", "13/2/2024", "2024-1-5", "2024-01-05 00:00:00"), ("25/2/2024", "x", None, "bad")],
        "mixed string, dmy string, iso string, stamp string",
    )
    names = df.columns
    assert steps.detect_date_formats(df, names) == {
        "mixed": "M/d/yyyy",
        "dmy": "d/M/yyyy",
        "iso": "yyyy-M-d",
        "stamp": None,
    }
    assert steps.detect_date_formats(df, ["mixed"], "best") == {"mixed": "d/M/yyyy"}
    c = Contract("t", None, tuple(Mapping(n, n, "timestamp") for n in names))
    got = [tuple(r) for r in steps.coerce(df, c, "fact").collect()]
    day = dt.date
    assert got == [
        (day(2024, 1, 2), day(2024, 2, 13), day(2024, 1, 5), day(2024, 1, 5)),
        (None, None, None, None),  # the whole mixed column is read month-first
    ]
    assert steps.coerce(df, c, "dim").collect()[1]["mixed"] == day(2024, 2, 25)


def test_load_fact(spark):
    df = spark.createDataFrame(
        [("1/15/2024", " a ", "1.5"), ("1/15/2023", "b", "2"), ("?", "c", "3"), ("2/20/2024", "  ", "nan")],
        "` When ` string, Code string, Amount string",
    )
    c = Contract(
        "t", "booked", (Mapping("when", "booked", "datetime"), Mapping("code", "code", "text"), Mapping("amount", "v", "FLOAT"))
    )
    got = steps.load(df, c, "fact", 2024).collect()
    assert [tuple(r) for r in got] == [(dt.date(2024, 1, 15), " a ", 1.5), (dt.date(2024, 2, 20), None, None)]
    with pytest.raises(ContractError, match="columns missing"):
        steps.load(df.drop("Code"), c, "fact", 2024)
    text_time = Contract("t", "code", c.mappings)
    with pytest.raises(ContractError, match="not a date"):
        steps.load(df, text_time, "fact", 2024)


@pytest.fixture
def schema(spark):
    folder = fresh_folder(spark)
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    return name


def test_year_slices(spark, schema):
    c = Contract("f", "d", (Mapping("d", "d", "timestamp"), Mapping("v", "v", "int")))
    table = sinks.ensure_table(spark, schema, c, by_year=True)

    def put(year, *values):
        rows = spark.createDataFrame([(dt.date(year, 1, 1), v) for v in values], c.schema)
        sinks.replace_year(rows, table, year)

    def state():
        return sorted((r["load_year"], r["v"]) for r in spark.table(table).collect())

    put(2023, 1, 2)
    put(2024, 3)
    put(2024, 3)
    assert state() == [(2023, 1), (2023, 2), (2024, 3)]  # a reload changes nothing
    put(2023)
    assert state() == [(2024, 3)]  # an empty slice empties its year
    wider = Contract("f", "d", (*c.mappings, Mapping("note", "NOTE", "varchar")))
    assert sinks.ensure_table(spark, schema, wider, by_year=True) == table
    assert sinks.evolve(spark.table(table).schema, wider) == []
    put(2025, 5)
    assert state() == [(2024, 3), (2025, 5)]
    assert {r["NOTE"] for r in spark.table(table).collect()} == {None}


def test_replace_all_from_itself(spark, schema):
    c = Contract("d", None, (Mapping("k", "k", "int"),))
    table = sinks.ensure_table(spark, schema, c)
    sinks.replace_all(spark.range(5).select(F.col("id").cast("int").alias("k")), table)
    sinks.replace_all(spark.table(table).filter("k > 2"), table)
    assert sorted(r["k"] for r in spark.table(table).collect()) == [3, 4]


def test_layout_prunes(spark, schema):
    df = spark.range(100).select(
        F.when(F.col("id") % 2 == 0, "actual").otherwise("planning").alias("source"), F.col("id").alias("kind")
    )
    table = sinks.materialise(df, f"{schema}.r", ("source",), ("kind",))
    found = table.filter("source = 'actual' AND kind = 4")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and "EqualTo(kind,4)" in plan
    assert found.count() == 1


def test_a_failed_load_changes_nothing(spark, schema):
    broken = F.raise_error(F.lit("broken cell"))
    c = Contract("d", None, (Mapping("k", "k", "int"),))
    table = sinks.ensure_table(spark, schema, c)
    sinks.replace_all(spark.range(5).select(F.col("id").cast("int").alias("k")), table)
    with pytest.raises(Exception, match="broken cell"):
        sinks.replace_all(spark.range(5).select(F.when(F.col("id") > 3, broken).otherwise(1).cast("int").alias("k")), table)
    assert spark.table(table).count() == 5
    c = Contract("f", "d", (Mapping("d", "d", "timestamp"), Mapping("v", "v", "int")))
    table = sinks.ensure_table(spark, schema, c, by_year=True)
    rows = spark.range(4).select(F.lit(dt.date(2023, 5, 1)).alias("d"), F.col("id").cast("int").alias("v"))
    sinks.replace_year(rows, table, 2023, "d")
    with pytest.raises(Exception, match="broken cell"):
        sinks.replace_year(rows.withColumn("v", F.when(F.col("v") > 2, broken).otherwise(1).cast("int")), table, 2023)
    with pytest.raises(ContractError, match="4 rows are not of 2022"):
        sinks.replace_year(rows, table, 2022, "d")
    assert [(r["load_year"], r["n"]) for r in spark.table(table).groupBy("load_year").agg(F.count("v").alias("n")).collect()] == [(2023, 4)]


def test_lenient_dates(spark):
    texts = {
        "2024-01-02T00:00:00Z": (2024, 1, 2),
        "2024-01-02T10:00:00+07:00": (2024, 1, 2),
        "5-Jan-2024": (2024, 1, 5),
        "Jan 5, 2024": (2024, 1, 5),
        " 1/2/2024": (2024, 1, 2),
        "1/2/24": (2024, 1, 2),
        "31-12-99": (1999, 12, 31),
        "2024.01.05": (2024, 1, 5),
        "30.12.2023": (2023, 12, 30),
        "1/2/2024 10:00 AM": (2024, 1, 2),
        "Feb 30, 2024": None,
        "x 1/2/2024": None,
        "": None,
    }
    got = column(spark, list(texts), to_date_lenient)
    assert got == [dt.date(*v) if v else None for v in texts.values()]


def test_long_numbers(spark):
    texts = ["12.0", "1e3", "12.5", "9007199254740993", "x", " 7 ", "1e30"]
    assert column(spark, texts, to_long) == [12, 1000, 13, 9007199254740993, None, 7, None]


def test_non_breaking_blanks(spark):
    assert column(spark, ["\u00a0", "\u3000 ", " a\u00a0", "\t"], blank_to_null) == [None, None, " a\u00a0", None]


def test_files_are_read_by_their_headers(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n2,1\n")
    got = steps.read_text_table(spark, str(tmp_path)).select("a", "b").collect()
    assert [tuple(r) for r in got] == [("1", "2")] * 2
    (tmp_path / "3.csv").write_text("a,b\n1,2,3\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        steps.read_text_table(spark, str(tmp_path)).collect()
    (tmp_path / "3.csv").write_text("a,c\n1,2\n")
    with pytest.raises(ContractError, match="differ"):
        steps.read_text_table(spark, str(tmp_path))


def test_declared_types(spark):
    kinds = ["decimal(10,2)", "NUMERIC (18, 4)", "smallint", "real", "varchar(20)", "numeric", "bigint"]
    c = Contract("t", None, tuple(Mapping(f"c{k}", f"c{k}", kind) for k, kind in enumerate(kinds)))
    types = ["decimal(10,2)", "decimal(18,4)", "int", "double", "string", "decimal(38,10)", "bigint"]
    assert [f.dataType.simpleString() for f in c.schema] == types


def test_contracts_that_cannot_be_loaded(spark):
    unmapped = Contract("t", "booked", (Mapping("v", "v", "int"),))
    with pytest.raises(ContractError, match="not mapped"):
        steps.load(spark.createDataFrame([("1",)], "v string"), unmapped, "fact", 2024)
    bad = [(1, None, "x; DROP TABLE y", None), (7, "a", "b", "int")]
    with pytest.raises(ContractError, match="not a table name"):
        Contract.from_cells(spark.createDataFrame(bad, CELLS))
    long = [(1, None, "t", None), *[(k, f"s{k}", f"c{k}", "int") for k in range(7, 12_000)]]
    assert len(Contract.from_cells(spark.createDataFrame(long, CELLS)).mappings) == 11_993


def test_intermediates_go_with_their_scope(spark):
    with intermediates(spark):
        kept = materialised(spark.range(5))
        folder = Path(kept.inputFiles()[0].removeprefix("file:")).parent
        assert kept.count() == 5 and folder.exists()
    assert not folder.exists()


def test_a_load_reads_its_text_once(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text("booked,v\n" + f"{k + 1}/2/2024,{k}\n" * 5)
    spark.sparkContext.setJobGroup("load", "one load")
    text = steps.read_text_table(spark, str(tmp_path))
    listed = len(spark.sparkContext.statusTracker().getJobIdsForGroup("load"))
    rows = steps.load(text, Contract("f", "booked", (Mapping("booked", "booked", "timestamp"), Mapping("v", "v", "int"))), "fact")
    staged = len(spark.sparkContext.statusTracker().getJobIdsForGroup("load"))
    spark.sparkContext.setJobGroup("later", "others")
    assert staged - listed == 1
    for k in range(3):
        (tmp_path / f"{k}.csv").unlink()  # what follows reads the staged rows
    assert rows.count() == 15 and {r["booked"] for r in rows.collect()} == {dt.date(2024, 1, 2), dt.date(2024, 2, 2), dt.date(2024, 3, 2)}


def test_headers_of_compressed_and_marked_files(spark, tmp_path):
    import gzip

    (tmp_path / "1 a.csv").write_bytes("\ufeffa,\"b,c\"\n1,2\n".encode())
    (tmp_path / "2.csv.gz").write_bytes(gzip.compress(b"\"b,c\",a\n2,1\n"))
    files = sorted("file:" + str(p) for p in tmp_path.iterdir())
    found = dict(steps._headers(spark, files))
    assert list(found.values()) == [("a", "b,c"), ("b,c", "a")]
    (tmp_path / "2.csv.gz").unlink()
    assert [tuple(r) for r in steps.read_text_table(spark, str(tmp_path)).select("a", "`b,c`").collect()] == [("1", "2")]
    (tmp_path / "3.csv").write_text("")
    assert steps._headers(spark, ["file:" + str(tmp_path / "3.csv")]) == []
