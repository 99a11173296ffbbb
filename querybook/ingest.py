"""Loading queries, over text exports of the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import to_date_lenient
from ledgerloom.functions.numbers import to_float, to_int
from ledgerloom.functions.text import blank_to_null, clean_text, null_tokens
from ledgerloom.sources import load as load_steps
from ledgerloom.sources import tables as sinks
from ledgerloom.sources.contract import Contract, ContractError
from ledgerloom.sources.workspace import fresh_folder, materialised
from querybook.fixtures import Inputs
from querybook.gold import workspace
from querybook.registry import cte, query

# The contract sheet, cell by cell: row, a, b, c.
CELLS = [
    (1, "table", " Fact_Ledger_Text ", None),
    (2, "time column", " Accounting_Date ", None),
    (6, "col_name_excel", "col_name_des", "type_of_col_des"),
    (7, " REF_ID", "Ref_Id", "int"),
    (8, "Date_Dmy_Only ", "accounting_date", "timestamp"),
    (9, "Amount", "amount", "Float"),
    (10, "note", "note", "varchar"),
    (11, "comment", None, "varchar"),
]


def contract(i: Inputs, *extra: tuple, without: tuple[int, ...] = ()) -> Contract:
    cells = [c for c in CELLS if c[0] not in without] + list(extra)
    return Contract.from_cells(i.spark.createDataFrame(cells, "row int, a string, b string, c string"))


def sheet(i: Inputs) -> DataFrame:
    """The landing table with the header spellings people type."""
    names = {"ref_id": " Ref_ID", "date_dmy_only": "DATE_DMY_ONLY ", "amount": "Amount", "note": "NOTE "}
    return i.view("ledger_text").withColumnsRenamed(names)


def rows(i: Inputs) -> DataFrame:
    return load_steps.load(sheet(i), contract(i), "fact")


_DMY = "CAST(try_strptime({c}, '%d/%m/%Y') AS DATE)"
_MDY = "CAST(try_strptime({c}, '%m/%d/%Y') AS DATE)"
_ISO = "CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)"
_NOTE = "CASE WHEN trim(note) IN ('', 'nan', 'NaT') THEN NULL ELSE note END"
cte(
    "t_loaded",
    f"""SELECT CAST(ref_id AS INTEGER) AS ref_id, {_DMY.format(c='date_dmy_only')} AS accounting_date,
               TRY_CAST(amount AS DOUBLE) AS amount, {_NOTE} AS note FROM {{v_ledger_text}}""",
)
_LOADED = "SELECT ref_id, accounting_date, round(amount, 2) AS amount, note FROM {t_loaded}"


def shown(df: DataFrame) -> DataFrame:
    return df.select("ref_id", "accounting_date", F.round("amount", 2).alias("amount"), "note")


def export(df: DataFrame, folder: str, *partition_by: str) -> None:
    """Write an exported sheet: every cell quoted, spaces kept."""
    writer = df.write.option("header", "true").option("quoteAll", "true").option("escape", '"')
    for side in ("Leading", "Trailing"):
        writer = writer.option(f"ignore{side}WhiteSpace", "false")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(folder)


@query(
    "ing_discover",
    """SELECT DISTINCT 'fact' AS kind, CAST(year(o_orderdate) AS INTEGER) AS year, 'ledger' AS dataset FROM {orders}
       UNION ALL SELECT DISTINCT 'dim', CAST(NULL AS INTEGER), 'dim_ob' FROM {region}""",
)
def discover(i: Inputs) -> DataFrame:
    root = fresh_folder(i.spark)
    text = i.view("ledger_text").withColumns({"year": F.substring("date_iso", 1, 4), "dataset": F.lit("ledger")})
    export(text, f"{root}/fact", "year", "dataset")
    export(i.loaded("dim_ob"), f"{root}/dim/dim_ob")
    return load_steps.discover(i.spark, root).select("kind", "year", "dataset").distinct()


@query("ing_text_scan", "SELECT ref_id, date_dmy_mixed, date_iso, amount, note FROM {v_ledger_text}")
def text_scan(i: Inputs) -> DataFrame:
    root = fresh_folder(i.spark)
    export(i.view("ledger_text"), root)
    return load_steps.read_text_table(i.spark, root).select("ref_id", "date_dmy_mixed", "date_iso", "amount", "note")


@query(
    "ing_contract",
    " UNION ALL ".join(
        f"""SELECT 'fact_ledger_text' AS table_name, 'accounting_date' AS time_column, '{src}' AS source, '{dst}' AS target,
                   '{kind}' AS type_name, count(*) AS n, count({dst}) AS valid FROM {{t_loaded}}"""
        for src, dst, kind in (
            ("ref_id", "ref_id", "int"),
            ("date_dmy_only", "accounting_date", "date"),
            ("amount", "amount", "double"),
            ("note", "note", "string"),
        )
    ),
)
def read_contract(i: Inputs) -> DataFrame:
    """What the contract declares, and how many cells of the sheet keep to it."""
    c = contract(i)
    counts = rows(i).agg(
        F.count(F.lit(1)).alias("n"), *[F.count(m.target).alias(f"valid_{m.target}") for m in c.mappings]
    )
    lines = [
        F.struct(
            F.lit(m.source).alias("source"),
            F.lit(m.target).alias("target"),
            F.lit(m.data_type.simpleString()).alias("type_name"),
            F.col("n"),
            F.col(f"valid_{m.target}").alias("valid"),
        )
        for m in c.mappings
    ]
    return counts.select(F.explode(F.array(*lines)).alias("x")).select(
        F.lit(c.table).alias("table_name"), F.lit(c.time_column).alias("time_column"), "x.*"
    )


@query("ing_create", _LOADED)
def create(i: Inputs) -> DataFrame:
    table = sinks.ensure_table(i.spark, workspace(i), contract(i))
    sinks.replace_all(rows(i), table)
    return shown(i.spark.table(table))


def years(loaded: DataFrame) -> list[int]:
    """The years that rows of a loaded sheet have; a row a year."""
    year = F.year("accounting_date").alias("year")
    return sorted(r["year"] for r in loaded.select(year).distinct().collect() if r["year"] is not None)


@query(
    "ing_evolve",
    """SELECT ref_id, CAST(NULL AS VARCHAR) AS date_iso, year(accounting_date) AS load_year FROM {t_loaded} WHERE year(accounting_date) <= 1995
       UNION ALL SELECT CAST(ref_id AS INTEGER), date_iso, CAST(right(date_dmy_only, 4) AS INTEGER) FROM {v_ledger_text}
       WHERE CAST(right(date_dmy_only, 4) AS INTEGER) > 1995""",
)
def evolve(i: Inputs) -> DataFrame:
    """A second contract adds a column; the years loaded before have no values in it."""
    schema = workspace(i)
    first = contract(i)
    table = sinks.ensure_table(i.spark, schema, first, by_year=True)
    loaded = materialised(load_steps.load(sheet(i), first, "fact"))
    for year in years(loaded):
        if year <= 1995:
            sinks.replace_year(load_steps.slice_year(loaded, "accounting_date", year), table, year)
    second = contract(i, (12, "date_iso", "DATE_ISO", "varchar"), (13, "note", "NOTE", "varchar"), without=(10,))
    sinks.ensure_table(i.spark, schema, second, by_year=True)
    loaded = materialised(load_steps.load(sheet(i), second, "fact"))
    for year in years(loaded):
        if year > 1995:
            sinks.replace_year(load_steps.slice_year(loaded, "accounting_date", year), table, year)
    return i.spark.table(table).select("ref_id", "date_iso", "load_year")


@query("ing_replace_all", f"{_LOADED} WHERE amount IS NOT NULL")
def replace_all(i: Inputs) -> DataFrame:
    """Loaded twice, then replaced by a selection of itself."""
    table = sinks.ensure_table(i.spark, workspace(i), contract(i))
    sinks.replace_all(rows(i), table)
    sinks.replace_all(rows(i), table)
    sinks.replace_all(i.spark.table(table).filter(F.col("amount").isNotNull()), table)
    return shown(i.spark.table(table))


@query(
    "ing_replace_year",
    f"{_LOADED} WHERE (year(accounting_date) <> 1996 OR amount > 100000) AND year(accounting_date) <> 1998",
)
def replace_year(i: Inputs) -> DataFrame:
    """All years loaded; 1996 reloaded with fewer rows, 1998 with none."""
    table = sinks.ensure_table(i.spark, workspace(i), contract(i), by_year=True)
    loaded = rows(i)
    sinks.replace_years(loaded, table, "accounting_date")
    again = load_steps.slice_year(loaded, "accounting_date", 1996).filter(F.col("amount") > 100000)
    sinks.replace_year(again, table, 1996)
    sinks.replace_year(loaded.filter(F.lit(False)), table, 1998)
    return shown(i.spark.table(table))


@query(
    "ing_validate",
    """SELECT 'complete' AS case_name, TRUE AS accepted, '' AS reason, count(*) AS n FROM {v_ledger_text}
       UNION ALL SELECT 'missing column', FALSE, 'columns missing: [''branch'']', count(*) FROM {v_ledger_text}
       UNION ALL SELECT 'not text', FALSE, 'columns not read as text: [''amount'']', count(*) FROM {v_ledger_text}
       UNION ALL SELECT 'no date', FALSE, 'time column ''accounting_date'' is not a date: varchar', count(*) FROM {v_ledger_text}""",
)
def validate(i: Inputs) -> DataFrame:
    text = load_steps.normalise_headers(sheet(i))
    no_date = contract(i, (8, "date_dmy_only", "accounting_date", "varchar"), without=(8,))
    cases = {
        "complete": (text, contract(i)),
        "missing column": (text, contract(i, (12, "branch", "branch", "varchar"))),
        "not text": (text.withColumn("amount", F.col("amount").try_cast("double")), contract(i)),
        "no date": (text, no_date),
    }

    def outcome(name: str, df: DataFrame, c: Contract) -> DataFrame:
        reason = ""
        try:
            load_steps.validate_input(df, c)
        except ContractError as error:
            reason = str(error)
        return df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("case_name"), F.lit(not reason).alias("accepted"), F.lit(reason).alias("reason"), "n"
        )

    return reduce(DataFrame.unionByName, [outcome(n, *case) for n, case in cases.items()])


@query("ing_map", "SELECT ref_id, date_dmy_only AS accounting_date, amount, note FROM {v_ledger_text}")
def mapped(i: Inputs) -> DataFrame:
    return load_steps.apply_mapping(load_steps.normalise_headers(sheet(i)), contract(i))


@query(
    "ing_dates",
    f"""SELECT ref_id, coalesce({_ISO.format(c='date_iso')}, {_MDY.format(c='date_iso')}) AS iso,
               coalesce({_MDY.format(c='date_dmy_mixed')}, {_DMY.format(c='date_dmy_mixed')}) AS mixed,
               coalesce({_MDY.format(c='note')}, {_DMY.format(c='note')}) AS bad FROM {{v_ledger_text}}""",
)
def dates(i: Inputs) -> DataFrame:
    """Cell by cell, so a mixed column loses no cell (but reads ambiguous ones month-first)."""
    return i.view("ledger_text").select(
        "ref_id",
        to_date_lenient(F.col("date_iso")).alias("iso"),
        to_date_lenient(F.col("date_dmy_mixed")).alias("mixed"),
        to_date_lenient(F.col("note")).alias("bad"),
    )


@query(
    "ing_date_detect",
    f"""SELECT ref_id, {_MDY.format(c='date_dmy_mixed')} AS date_dmy_mixed, {_DMY.format(c='date_dmy_only')} AS date_dmy_only,
               {_ISO.format(c='date_iso')} AS date_iso, {_DMY.format(c='date_dmy_mixed')} AS date_dmy_mixed_best FROM {{v_ledger_text}}""",
)
def date_detect(i: Inputs) -> DataFrame:
    """One format per column: the first that fits any cell, or the one that fits most."""
    columns = ["date_dmy_mixed", "date_dmy_only", "date_iso"]
    text, counts = load_steps.staged_counts(i.view("ledger_text").select("ref_id", *columns), columns)
    first, best = (load_steps.choose_formats(counts, columns, mode) for mode in ("first", "best"))
    return text.select(
        "ref_id",
        *[load_steps.parse_date(F.col(c), first[c]).alias(c) for c in columns],
        load_steps.parse_date(F.col("date_dmy_mixed"), best["date_dmy_mixed"]).alias("date_dmy_mixed_best"),
    )


@query(
    "ing_numeric",
    """SELECT ref_id, round(TRY_CAST(amount AS DOUBLE), 2) AS amount,
              CAST(round(TRY_CAST(amount AS DOUBLE)) AS INTEGER) AS whole, TRY_CAST(date_iso AS DOUBLE) AS bad FROM {v_ledger_text}""",
)
def numeric(i: Inputs) -> DataFrame:
    return i.view("ledger_text").select(
        "ref_id",
        F.round(to_float(F.col("amount")), 2).alias("amount"),
        to_int(F.col("amount")).alias("whole"),
        to_float(F.col("date_iso")).alias("bad"),
    )


@query(
    "ing_text_clean",
    f"""SELECT ref_id, CASE WHEN trim(note) = '' THEN NULL ELSE note END AS blank, CASE WHEN note IN ('nan', 'NaT') THEN NULL ELSE note END AS tokens,
               {_NOTE} AS cleaned FROM {{v_ledger_text}}""",
)
def text_clean(i: Inputs) -> DataFrame:
    note = F.col("note")
    return i.view("ledger_text").select(
        "ref_id",
        blank_to_null(note).alias("blank"),
        null_tokens(note).alias("tokens"),
        clean_text(note).alias("cleaned"),
    )


@query("ing_year_slice", f"{_LOADED} WHERE year(accounting_date) = 1996")
def year_slice(i: Inputs) -> DataFrame:
    return shown(load_steps.load(sheet(i), contract(i), "fact", 1996))
