"""From text tables to typed rows: discover, read, check, map, coerce, slice."""

from __future__ import annotations

import csv
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Literal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ledgerloom.functions.dates import COLUMN_FORMATS, parse_date, to_date_lenient
from ledgerloom.functions.numbers import to_float, to_int, to_long
from ledgerloom.functions.text import clean_text
from ledgerloom.sources.contract import Contract, ContractError
from ledgerloom.sources.workspace import materialised

Kind = Literal["dim", "fact"]

_LAYOUT = r"/(dim|fact)/(?:(?:year=)?(\d{4})/)?(?:dataset=)?([^/.]+)"


def discover(spark: SparkSession, root: str, glob: str = "*.{csv,parquet}") -> DataFrame:
    """Input files below ``root``: ``dim/<dataset>`` and ``fact/<year>/<dataset>``.

    Only file names are listed; contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    path = F.col("path")
    return (
        files.load(root)
        .select("path")
        .filter(path.rlike(_LAYOUT))
        .select(
            "path",
            F.regexp_extract(path, _LAYOUT, 1).alias("kind"),
            F.regexp_extract(path, _LAYOUT, 2).try_cast("int").alias("year"),
            F.regexp_extract(path, _LAYOUT, 3).alias("dataset"),
        )
    )


def read_text_table(spark: SparkSession, *paths: str, multi_line: bool = False) -> DataFrame:
    """Exported sheets with every column as text.

    Files are read by the header each has: columns are put together by name, and files whose
    headers name other columns are refused. A row with more or fewer cells than its header
    fails the load. Set ``multi_line`` when cells hold line breaks; only without it are files
    split between tasks.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
    files = [r["path"] for r in listed.load(list(paths)).select("path").collect()]  # names only
    reader = spark.read.option("header", "true").option("inferSchema", "false").option("multiLine", multi_line)
    reader = reader.option("escape", '"').option("mode", "FAILFAST").option("enforceSchema", "false")
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file, header in _headers(spark, files):
        by_header.setdefault(header, []).append(file)
    if not by_header:
        return reader.csv(list(paths))
    columns = sorted(next(iter(by_header)))
    if any(sorted(header) != columns for header in by_header):
        raise ContractError(f"files of one table differ in their columns: {sorted(by_header)}")
    texts = [reader.schema(StructType([StructField(c, StringType()) for c in h])).csv(f) for h, f in by_header.items()]
    return reduce(DataFrame.unionByName, texts)


def _headers(spark: SparkSession, files: list[str]) -> list[tuple[str, tuple[str, ...]]]:
    """Each file with the column names in its first line; the rest of it is not read."""
    with ThreadPool(min(32, max(1, len(files)))) as pool:
        lines = pool.map(lambda file: _first_line(spark, file), files)
    return [(file, tuple(next(csv.reader([line])))) for file, line in zip(files, lines, strict=True) if line]


def _first_line(spark: SparkSession, file: str) -> str | None:
    """A text file's first line, through the file system Spark has for it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        opened = stream if codec is None else codec.createInputStream(stream)
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(opened, "UTF-8")).readLine()
    finally:
        stream.close()
    return None if line is None else line.removeprefix("\ufeff")


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def validate_input(df: DataFrame, contract: Contract) -> None:
    """Every mapped source column must be there, as text, and the time column must be a date."""
    missing = [m.source for m in contract.mappings if m.source not in df.columns]
    if missing:
        raise ContractError(f"columns missing: {missing}")
    typed = [m.source for m in contract.mappings if not isinstance(df.schema[m.source].dataType, StringType)]
    if typed:
        raise ContractError(f"columns not read as text: {typed}")
    require_temporal(contract)


def require_temporal(contract: Contract) -> None:
    time = [m for m in contract.mappings if m.target.lower() == contract.time_column]
    if contract.time_column and not time:
        raise ContractError(f"time column {contract.time_column!r} is not mapped")
    if time and not isinstance(time[0].data_type, DateType):
        raise ContractError(f"time column {contract.time_column!r} is not a date: {time[0].type_name}")


def apply_mapping(df: DataFrame, contract: Contract) -> DataFrame:
    """Mapped columns only, under their target names."""
    return df.select(*[F.col(f"`{m.source}`").alias(m.target) for m in contract.mappings])


Mode = Literal["first", "best"]


def _format_counts(columns: list[str]) -> list[Column]:
    """How many cells of each column fit each format."""
    return [
        F.count(parse_date(F.col(c), fmt)).alias(f"{i}_{j}") for i, c in enumerate(columns) for j, fmt in enumerate(COLUMN_FORMATS)
    ]


def choose_formats(counts: dict[str, int], columns: list[str], mode: Mode = "first") -> dict[str, str | None]:
    """One format per column, decided on all its cells.

    ``first`` takes the first format any cell fits, so a day-first column with a day
    up to 12 is read month-first, as the fixed order of formats has it; ``best``
    takes the format most cells fit (the earlier one on a tie). None: no format fits.
    """
    found: dict[str, str | None] = {}
    for i, c in enumerate(columns):
        valid = [counts[f"{i}_{j}"] for j in range(len(COLUMN_FORMATS))]
        fits = [j for j, n in enumerate(valid) if n > 0]
        if mode == "best":
            fits.sort(key=lambda j: -valid[j])
        found[c] = COLUMN_FORMATS[fits[0]] if fits else None
    return found


def staged_counts(df: DataFrame, columns: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """The text rows, written, and the counts to choose date formats by, which are taken while
    they are written: the text is read once, all that follows reads the written columns."""
    if not columns:
        return df, {}
    seen = Observation()
    stored = materialised(df.observe(seen, *_format_counts(columns)))
    return stored, seen.get


def detect_date_formats(df: DataFrame, columns: list[str], mode: Mode = "first") -> dict[str, str | None]:
    """The same decision by an aggregation alone, for rows that need not be written."""
    return choose_formats(df.agg(*_format_counts(columns)).first().asDict(), columns, mode) if columns else {}


def coerce(df: DataFrame, contract: Contract, kind: Kind, mode: Mode = "first") -> DataFrame:
    """Typed columns; cells that do not fit their type become NULL. A fact's text is staged."""
    dates = [m.target for m in contract.mappings if isinstance(m.data_type, DateType)]
    formats: dict[str, str | None] = {}
    if kind == "fact":
        df, counts = staged_counts(df, dates)
        formats = choose_formats(counts, dates, mode)

    def typed(name: str, data_type) -> Column:
        c = F.col(name)
        if isinstance(data_type, DateType):
            return parse_date(c, formats[name]) if formats.get(name) else to_date_lenient(c)
        if isinstance(data_type, DoubleType):
            return to_float(c)
        if isinstance(data_type, IntegerType):
            return to_int(c)
        if isinstance(data_type, LongType):
            return to_long(c)
        cleaned = clean_text(c)
        return cleaned if isinstance(data_type, StringType) else cleaned.try_cast(data_type)

    return df.select(*[typed(m.target, m.data_type).alias(m.target) for m in contract.mappings])


def slice_year(df: DataFrame, time_column: str, year: int) -> DataFrame:
    """Rows of one year; a range on the date itself, which reaches the scan."""
    c = F.col(time_column)
    start, end = F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))
    return df.filter((c >= start) & (c < end))


def load(df: DataFrame, contract: Contract, kind: Kind, year: int | None = None) -> DataFrame:
    """Check, map and coerce a text table; a fact also keeps only the load year.

    For all years of a sheet leave ``year`` out and give the rows to ``tables.replace_years``.
    """
    if kind == "fact":
        df = normalise_headers(df)
    validate_input(df, contract)
    rows = coerce(apply_mapping(df, contract), contract, kind)
    if kind == "fact" and year is not None and contract.time_column in rows.columns:
        rows = slice_year(rows, contract.time_column, year)
    return rows
