"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

Format. A folder holds Parquet files whose rows are blocks, one folder ``shard=k`` for each
range of documents, and the folder ``ranks``. A block has whole documents in ascending order:

=========== =========================================================================
first       ids in the shard before this block
doc_ids     8 bytes a document, signed, little-endian
has_id      one byte a document, 0 if its doc_id was null
counts      4 bytes a document: its ids, the end id included
control     2 bits an id: bytes of its code less one; four ids a byte, low bits first
codes       the ranks of the ids, little-endian, in as many bytes as ``control`` says
=========== =========================================================================

``ranks`` has the id of each rank; the most frequent id is rank 0, ties by id. The 256 most
frequent ids take one byte, the next 65,280 two.

Defined results: a null text is empty (the end id alone); rows of a null doc_id come first;
rows that repeat a doc_id are all kept, ordered by a hash of their text; an empty table gives
an empty folder; other columns are not read. A block closes at ``BLOCK_IDS`` ids, a longer
document is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.chunks import bpe_ids, forget_tables, tokenizer, with_end
from ledgerloom.llm.stage import Scratch, binary, mapped, portions, slices, texts_of

BLOCK_IDS = 1 << 18
IDS = "shard int, first long, doc_id long, ids binary"
BLOCKS = "shard int, first long, n_ids long, doc_ids binary, has_id binary, counts binary, control binary, codes binary"


# --- the coding ---------------------------------------------------------------------------


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and code bytes of ranks below 2^32."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    quads = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    quads[: len(ranks)] = extra
    quads = quads.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    control = quads[:, 0] | quads[:, 1] | quads[:, 2] | quads[:, 3]
    codes = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return control.tobytes(), codes.tobytes()


@lru_cache(maxsize=1)
def _length_table() -> np.ndarray:
    """The four code lengths that each control byte stands for."""
    return ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def decode_ranks(control: bytes, codes: bytes, n: int) -> np.ndarray:
    """The inverse of ``encode_ranks`` for ``n`` ranks, by table lookup."""
    lengths = _length_table()[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    data = np.frombuffer(codes, np.uint8)
    ranks = data[starts].astype("<u4")
    for k in (1, 2, 3):
        if not len(more := np.flatnonzero(lengths > k)):
            break
        ranks[more] |= data[starts[more] + k].astype("<u4") << np.uint32(8 * k)
    return ranks


# --- writing ------------------------------------------------------------------------------


def tokenize_in_order(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Ids of each document in ascending doc_id order; a shard is a range of doc_ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first = TaskContext.get().partitionId(), 0
        for batch in portions(batches):
            ids, bounds = with_end(*bpe_ids(tokenizer_path, texts_of(batch.column(1))), end_id)
            columns = [
                pa.array(np.full(batch.num_rows, shard, np.int32)),
                pa.array(first + bounds[:-1]),
                batch.column(0),
                slices(ids, bounds).cast(pa.binary()),
            ]
            first += int(bounds[-1])
            yield pa.RecordBatch.from_arrays(columns, ["shard", "first", "doc_id", "ids"])

    order = ("doc_id", "tie")
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.mapInArrow(run, IDS)


def rank_ids(ids: DataFrame, vocabulary: int) -> list[int]:
    """The ids of a vocabulary by frequency over all documents; its size bounds the list."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        forget_tables()
        data, _ = binary(batch.column(0))
        n = np.bincount(data.view("<u4"))
        seen = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen])], ["id", "n"])

    counts = mapped(ids.select("ids"), count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    seen = {r["id"]: r["n"] for r in counts.collect()}
    return sorted(range(max(vocabulary, max(seen, default=-1) + 1)), key=lambda i: (-seen.get(i, 0), i))


def code_blocks(ids: DataFrame, id_of_rank: list[int]) -> DataFrame:
    rank_of_id = np.empty(len(id_of_rank), "<u4")
    rank_of_id[id_of_rank] = np.arange(len(id_of_rank), dtype="<u4")

    def block(rows: list[tuple]) -> dict:
        flat = np.frombuffer(b"".join(r[3] for r in rows), "<u4")
        control, codes = encode_ranks(rank_of_id[flat])
        return {
            "shard": rows[0][0],
            "first": rows[0][1],
            "n_ids": len(flat),
            "doc_ids": np.array([r[2] or 0 for r in rows], "<i8").tobytes(),
            "has_id": bytes(r[2] is not None for r in rows),
            "counts": np.array([len(r[3]) // 4 for r in rows], "<u4").tobytes(),
            "control": control,
            "codes": codes,
        }

    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in BLOCKS.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_tables()
        rows: list[tuple] = []
        size, after = 0, None
        for batch in portions(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = len(row[3]) // 4
                if rows and (size + n > BLOCK_IDS or (row[0], row[1]) != after):
                    yield pa.RecordBatch.from_pylist([block(rows)], schema)
                    rows, size = [], 0
                rows.append(row)
                size, after = size + n, (row[0], row[1] + n)
        if rows:
            yield pa.RecordBatch.from_pylist([block(rows)], schema)

    return ids.mapInArrow(run, BLOCKS)


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, scratch: Scratch) -> None:
    """Tokenize ``docs`` (doc_id, text) with a tokenizers file and write the folder."""
    spark = docs.sparkSession
    ids = scratch.save(tokenize_in_order(docs, tokenizer_path, end_id), "ids")
    order = rank_ids(ids, max(tokenizer(tokenizer_path).get_vocab_size(), end_id + 1))
    spark.createDataFrame(list(enumerate(order)), "rank int, id int").coalesce(1).write.parquet(f"{folder}/ranks")
    code_blocks(ids, order).write.partitionBy("shard").parquet(f"{folder}/blocks")
    scratch.drop("ids")


# --- reading ------------------------------------------------------------------------------


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (little-endian unsigned 32 bits)."""
    ranks = spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()  # the vocabulary
    id_of_rank = np.array([r["id"] for r in ranks], "<u4")
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # a row a file
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.select("shard", F.coalesce(before, F.lit(0)).alias("before"))
    placed = blocks.join(shards, "shard").withColumn("first", F.col("first") + F.col("before"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_tables()
        for batch in portions(batches):
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
                ids = id_of_rank[decode_ranks(row["control"], row["codes"], row["n_ids"])]
                bounds = np.concatenate([[0], np.cumsum(counts)])
                doc_ids = pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=np.frombuffer(row["has_id"], np.uint8) == 0)
                columns = [doc_ids, pa.array(row["first"] + bounds[:-1]), slices(ids, bounds).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "ids"])

    columns = placed.select("first", "n_ids", "doc_ids", "has_id", "counts", "control", "codes")
    return columns.mapInArrow(decode, "doc_id long, start long, ids binary")


def digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what ``read_token_files`` returns, by Spark's own
    functions: a second Python worker beside the one that decodes would hold memory of its own."""
    n_tokens = F.shiftright(F.octet_length("ids").cast("long"), 2)
    return tokens.select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
