"""Best-fit packing by minimum bin slack.

A bin's filling depends on lengths only, so it is planned on the histogram of lengths, which
has at most ``capacity`` rows whatever the corpus. Per bin, a subset-sum dynamic programme
over bitsets finds the fullest combination of available lengths that holds the largest one;
the combination is removed as often as the supply of its lengths allows (it stays the fullest
until one of them runs short), and the search goes on with what is left. Spark counts the
lengths, numbers the pieces of each length, and looks up the bin and offset of each number.

Defined results: a null or empty text is a document of the end id alone; documents longer
than the capacity are cut into full pieces, the last may be shorter; rows that repeat a
doc_id are packed each; pieces of a null doc_id are packed too; an empty table gives no rows;
other columns of the documents are not read. Equal lengths take the planned places in a fixed order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.chunks import TABLE_ENTRIES, bpe_ids, with_end
from ledgerloom.llm.stage import mapped, slices, texts_of

SALTS = 256  # sub-groups in which the pieces of one length are numbered
PIECES = "doc_id long, piece int, start long, length long, "


def fullest(supply: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest feasible combination of lengths that holds the largest one.

    ``reach`` has bit s set if some combination of the lengths seen so far adds up to s.
    """
    largest = max(supply)
    room, reach = capacity - largest, 1
    full, seen = (1 << (room + 1)) - 1, []
    for length in sorted((x for x in supply if x <= room), reverse=True):
        times = min(supply[length] - (length == largest), room // length)
        before, step, left = reach, 1, times
        while left:  # 1, 2, 4, ... copies at a time
            take = min(step, left)
            reach |= (reach << (take * length)) & full
            left, step = left - take, step * 2
        seen.append((length, times, before))
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, {largest: 1}
    for length, times, before in reversed(seen):
        used = next(k for k in range(times + 1) if total >= k * length and before >> (total - k * length) & 1)
        if used:
            chosen[length] = chosen.get(length, 0) + used
            total -= used * length
    return chosen


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """How often each combination of lengths is used."""
    supply, bins = {n: c for n, c in histogram.items() if c}, []
    while supply:
        chosen = fullest(supply, capacity)
        times = min(supply[n] // k for n, k in chosen.items())
        bins.append((times, chosen))
        for n, k in chosen.items():
            supply[n] -= times * k
            if not supply[n]:
                del supply[n]
    return bins


def places(bins: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, last number, first sequence, copies a sequence, offset): the
    pieces of a length with these numbers fill the sequences from the first on in order."""
    rows, used, sequence = [], {}, 0
    for times, chosen in bins:
        offset = 0
        for length in sorted(chosen, reverse=True):
            copies, first = chosen[length], used.get(length, 0)
            rows.append((length, first, first + times * copies - 1, sequence, copies, offset))
            used[length] = first + times * copies
            offset += length * copies
        sequence += times
    return rows


def token_pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 4096, crc: bool = False, entries: int = TABLE_ENTRIES
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each document, the end id included; with ``crc``
    the unsigned checksum ``ids_crc32`` of a piece's ids in place of the ids. ``entries`` is the
    size of a Python worker's chunk table, which it keeps as long as it lives."""
    content = "ids_crc32" if crc else "ids"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, bounds = with_end(*bpe_ids(tokenizer_path, texts_of(batch.column(1)), entries), end_id)
        sizes = np.diff(bounds)
        n = -(-sizes // capacity)
        doc = np.repeat(np.arange(len(sizes)), n)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        start = piece * capacity
        length = np.minimum(sizes[doc] - start, capacity)
        at = np.append(bounds[doc] + start, bounds[-1])
        columns = [
            batch.column(0).take(pa.array(doc)),
            pa.array(piece.astype(np.int32)),
            pa.array(start),
            pa.array(length),
        ]
        if crc:
            data = ids.astype("<u4").tobytes()
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            columns.append(pa.array(sums, pa.int64()))
        else:
            columns.append(slices(ids, at).cast(pa.binary()))
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", content])

    schema = PIECES + ("ids_crc32 long" if crc else "ids binary")
    return mapped(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def assign(pieces: DataFrame, capacity: int = 4096, salts: int = SALTS) -> DataFrame:
    """``pieces`` (with doc_id, piece and length; a written table, as it is read twice) with
    ``sequence_id`` and ``offset``. Columns named ``_salt``, ``_rank``, ``_before``,
    ``_first``, ``_last``, ``_sequence``, ``_copies`` and ``_at`` are refused."""
    helpers = {"_salt", "_rank", "_before", "_first", "_last", "_sequence", "_copies", "_at"}
    if clash := helpers & set(pieces.columns):
        raise ValueError(f"columns {sorted(clash)} clash with helper columns")
    spark = pieces.sparkSession
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    counts = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))  # capacity x salts rows at most
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("length", "_salt", F.coalesce(before, F.lit(0)).alias("_before"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(n > capacity for n in histogram):
        raise ValueError(f"pieces longer than {capacity}")
    rows = places(plan(histogram, capacity))
    schema = "length long, _first long, _last long, _sequence long, _copies long, _at long"
    slots = spark.createDataFrame(rows, schema)
    number = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", *_ties(pieces)))
    ranked = salted.withColumn("_rank", number - 1).join(bases, ["length", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))
    found = ranked.join(
        F.broadcast(slots),  # a row a combination and length: bounded by the capacity
        (ranked["length"] == slots["length"]) & F.col("_rank").between(F.col("_first"), F.col("_last")),
    ).drop(slots["length"])
    at = F.col("_rank") - F.col("_first")
    sequence = F.col("_sequence") + F.floor(at / F.col("_copies"))
    offset = F.col("_at") + F.col("length") * F.pmod(at, F.col("_copies"))
    return found.select(*pieces.columns, sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))


def _ties(pieces: DataFrame) -> list[str]:
    return [c for c in ("start", "ids_crc32") if c in pieces.columns]


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id and the ids of each sequence, from placed pieces that have ``ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # one sequence: capacity ids at most
    joined = F.aggregate(parts, F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"))
