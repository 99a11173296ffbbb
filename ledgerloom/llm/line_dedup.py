"""Line deduplication with levelled sorted runs of line hashes.

A run is a bucketed table sorted by line key, with the number of documents that hold each key
and the largest of their doc_ids. Runs share no key: a new batch is merge-joined with
every run, and only keys that none has become a run of their own; the others stay beside them
as repeats. ``fanout`` runs of a level are merged into one of the next. At the end the repeats
are merged into the runs, keys of enough documents become decisions, and documents lose the
lines decided against.

Defined results: a null or empty text is one empty line; lines split at ``\\n`` only; a null
doc_id counts as one document below all others; rows that repeat a doc_id are one document
and keep or lose a line together; an empty table gives no rows. Other columns come back
unchanged, except ``n_lines`` and ``n_dropped``, which are replaced.
"""

from __future__ import annotations

import uuid
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ledgerloom.llm.stage import Scratch, mapped, packed, unpacked

STRIPPED = b" \t\n\x0b\x0c\r"
LEAST_ID = -(1 << 63)


def line_key(line: bytes, least: int) -> bytes | None:
    """16 bytes for a line of at least ``least`` code points after stripping and folding."""
    key = line.strip(STRIPPED).lower()  # bytes fold A-Z only
    if len(key) < least or (len(key) < 4 * least and len(key.decode()) < least):
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(docs: DataFrame, least: int) -> DataFrame:
    """doc, key: once for each row and key."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, keys = [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = {k for line in (text or "").encode().split(b"\n") if (k := line_key(line, least))}
            ids.extend([doc] * len(own))
            keys.extend(own)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["doc", "key"])

    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("doc")
    return mapped(docs.select(doc, "text"), run, "doc long, key binary")


class LineRuns:
    """The levelled runs. Rows: key, n (documents), keeper (their largest doc_id)."""

    def __init__(self, spark: SparkSession, scratch: Scratch, fanout: int = 3):
        self._spark, self._scratch, self._fanout = spark, scratch, fanout
        self._buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._prefix, self._made = f"line_runs_{uuid.uuid4().hex[:12]}", 0
        self._levels: list[list[str]] = [[]]
        self._repeats: list[DataFrame] = []
        self._tables: set[str] = set()

    def _bucketed(self, rows: DataFrame) -> str:
        self._made += 1
        name = f"{self._prefix}_{self._made}"
        rows = rows.repartition(self._buckets, "key")
        writer = rows.write.format("parquet").option("path", self._scratch.path(name)).option("compression", "zstd")
        writer.bucketBy(self._buckets, "key").sortBy("key").saveAsTable(name)
        self._tables.add(name)
        return name

    def _drop(self, *names: str) -> None:
        for name in names:
            self._spark.sql(f"DROP TABLE {name}")
            self._scratch.drop(name)
            self._tables.discard(name)

    def _fresh(self, name: str) -> DataFrame:
        return self._spark.table(name).filter("NOT known").drop("known")

    def _runs(self) -> list[DataFrame]:
        return [self._fresh(name) for level in self._levels for name in level]

    def add(self, batch: DataFrame) -> None:
        """Merge a batch (doc, key) in: new keys are a run, known ones repeats. Both are one table,
        written by one job, as every job writes a file a bucket."""
        keys = batch.groupBy("key").agg(F.count_distinct("doc").alias("n"), F.max("doc").alias("keeper"))
        known = F.lit(False)
        for k, run in enumerate(self._runs()):
            keys = keys.join(run.select("key", F.lit(True).alias(f"in_{k}")), "key", "left")  # anti-join: fresh if nothing is found
            known |= F.col(f"in_{k}").isNotNull()
        name = self._bucketed(keys.select("key", "n", "keeper", known.alias("known")))
        self._repeats.append(self._spark.table(name).filter("known").drop("known"))
        self._levels[0].append(name)
        self._compact()

    def _compact(self) -> None:
        level = 0
        while len(self._levels[level]) >= self._fanout:
            names, self._levels[level] = self._levels[level], []
            if level + 1 == len(self._levels):
                self._levels.append([])
            union = reduce(DataFrame.unionByName, [self._fresh(name) for name in names])
            self._levels[level + 1].append(self._bucketed(union.withColumn("known", F.lit(False))))
            if level:  # tables of the first level hold repeats, read at the end
                self._drop(*names)
            level += 1

    def decisions(self, documents: int) -> DataFrame:
        """key, keeper of the keys that at least so many documents hold. Ends the runs."""
        found = None
        runs = self._runs()
        if len(self._repeats) > 1:
            seen = reduce(DataFrame.unionByName, self._repeats[1:])  # the first batch has none
            seen = seen.groupBy("key").agg(F.sum("n").alias("more"), F.max("keeper").alias("later"))
            repeats = self._spark.table(self._bucketed(seen))
            runs = [
                run.join(repeats, "key", "left").select(
                    "key",
                    (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"),
                    F.greatest("keeper", "later").alias("keeper"),
                )
                for run in runs
            ]
        for run in runs:
            enough = run.filter(F.col("n") >= documents).select("key", "keeper")
            found = enough if found is None else found.unionByName(enough)
        saved = self._scratch.save(found, "decisions")
        self._drop(*list(self._tables))
        return saved


def dedup_lines(
    docs: DataFrame, scratch: Scratch, least: int = 20, documents: int = 3, batches: int = 6, fanout: int = 3
) -> DataFrame:
    """``docs`` without the lines that ``documents`` or more hold, except in the largest doc_id.

    The table is taken as ``batches`` arrivals, dealt by a hash of doc_id.
    """
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int").alias("batch")
    lines = scratch.save(line_keys(docs, least).select("doc", "key", batch), "lines", "batch")
    runs = LineRuns(spark, scratch, fanout)
    for k in range(batches):
        runs.add(lines.filter(F.col("batch") == k).select("doc", "key"))
    decisions = runs.decisions(documents)
    losing = lines.join(decisions, "key").filter(F.col("doc") < F.col("keeper"))
    losing = losing.groupBy("doc").agg(F.collect_set("key").alias("losing"))  # one document's lines
    rows = packed(docs, "doc_id", "text", without=("n_lines", "n_dropped"))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID))
    rows = rows.withColumn("doc", doc).join(losing, "doc", "left").select("doc_id", "text", "rest", "losing")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, n_lines, n_dropped = [], [], []
        for text, lost in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
            lines = (text or "").encode().split(b"\n")
            n_lines.append(len(lines))
            if lost:
                lost = set(lost)
                lines = [line for line in lines if line_key(line, least) not in lost]
            n_dropped.append(n_lines[-1] - len(lines))
            kept.append(text if not n_dropped[-1] and text is not None else b"\n".join(lines).decode())
        columns = [batch.column(0), pa.array(kept, pa.string()), batch.column(2)]
        columns += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "rest", "n_lines", "n_dropped"])

    schema = StructType(rows.schema.fields[:3]).add("n_lines", LongType()).add("n_dropped", LongType())
    return unpacked(mapped(rows, run, schema), "doc_id", "text", "n_lines", "n_dropped")


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH lines AS (
    SELECT doc_id, UNNEST(string_split(coalesce(text, ''), chr(10))) AS line,
           UNNEST(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM {documents}
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), decided AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.*, d.key IS NOT NULL AND k.doc_id <> d.keeper AS lost FROM keyed k LEFT JOIN decided d ON k.key = d.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
