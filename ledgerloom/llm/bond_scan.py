"""Hard negatives by a vertical scan with branch-and-bound (BOND).

Vectors become integers and are written in blocks, column by column, with each column's
smallest and largest value. An anchor reads a block's columns in the order of its own
components, largest magnitude first. After some columns, the partial score and what the
columns left can add at least and at most (by their extremes) bound each candidate's score;
the bitmap of candidates keeps those that can still enter a window: a range of scores with
room for ``k``, whose floor rises with the best found so far. What is left in the end has its
exact score, so windows are exact.

Anchors go through the blocks in chunks of at most about ``CHUNK`` components, each chunk
broadcast; no vector is shuffled. A sixteenth of the blocks goes first, and the windows'
floors from there hold for the rest, so that tasks send few rows. Two passes a chunk: the
``positives`` nearest of the anchor's label, then, for each, the ``negatives`` nearest of other
labels whose score is between the given shares of the positive's.

Defined results: rows without vec_id or label, and vectors that are null or hold null or
non-finite components, take no part; a zero or empty vector does (score 0); shorter vectors
count as filled up with zeros; ties go to the smaller vec_id; rows that repeat a vec_id are
rows of their own, none of them a candidate of another, and the one with the smallest label
and vector asks; scaled components saturate at 2^62 and scores at the range of a long; an
empty table gives no rows; columns other than vec_id, label and embedding are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.stage import Scratch

BLOCK = 4096  # rows a block, and
VALUES = 1 << 19  # components a block at most (one row at least)
CHUNK = 1 << 20
STOPS = (0.25, 0.5, 0.75, 0.875)  # shares of the columns read before candidates are judged
EXACT = float(1 << 53)
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
BLOCKS = "vec_ids binary, labels binary, columns binary, wide boolean, low binary, high binary, first boolean"
FOUND = "anchor_id long, slot int, score long, vec_id long"


def taking_part(rows: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("embedding"))
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)


def integers(column: pa.Array, scale: float) -> np.ndarray:
    """Rows of ``floor(scale * x)``, filled up with zeros to the longest."""
    sizes = np.diff(column.offsets.to_numpy())
    x = np.zeros((len(sizes), max(sizes, default=0)))
    x[np.arange(x.shape[1]) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * x), -(2.0**62), 2.0**62).astype(np.int64)


def write_blocks(rows: DataFrame, scratch: Scratch, scale: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = pc.sort_indices(batch, [("label", "ascending"), ("vec_id", "ascending")])
            widest = pc.max(pc.list_value_length(batch.column(2))).as_py() or 0
            size = max(1, min(BLOCK, VALUES // max(widest, 1)))
            for a in range(0, batch.num_rows, size):
                part = batch.take(order[a : a + size])
                x = np.ascontiguousarray(integers(part.column(2), scale).T)
                wide = bool(x.size and (x.min() < -(1 << 31) or x.max() >= 1 << 31))
                ids = part.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array([v.tobytes()], pa.binary()) for v in (ids, part.column(1).to_numpy(), x if wide else x.astype(np.int32))),
                        pa.array([wide]),
                        *(pa.array([f(x, axis=1).tobytes()], pa.binary()) for f in (np.min, np.max)),
                        pa.array([hash((int(ids[0]), len(ids))) % 16 == 0]),
                    ],
                    names=["vec_ids", "labels", "columns", "wide", "low", "high", "first"],
                )

    return scratch.save(rows.mapInArrow(run, BLOCKS), "blocks", "first")


@dataclass
class Block:
    ids: np.ndarray
    labels: np.ndarray  # ascending
    columns: np.ndarray  # a row for each component
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Block:
        ids, labels, low, high = (np.frombuffer(row[k], np.int64) for k in ("vec_ids", "labels", "low", "high"))
        columns = np.frombuffer(row["columns"], np.int64 if row["wide"] else np.int32).reshape(len(low), len(ids))
        return cls(ids, labels, columns if row["wide"] else columns.astype(float), low, high)


@dataclass
class Anchors:
    """A chunk of anchors and the windows of scores that each asks for (lower > upper: none)."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray  # a row for each anchor
    lower: np.ndarray  # anchors x windows
    upper: np.ndarray
    same_label: bool
    k: int


class Best:
    """The ``k`` best (score, vec_id) of each window so far."""

    def __init__(self, anchors: Anchors):
        shape = (*anchors.lower.shape, anchors.k)
        self.scores, self.ids, self.filled = np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(shape[:2], np.int32)
        self.k, self.floor = anchors.k, anchors.lower.copy()

    def add(self, a: int, w: int, scores: np.ndarray, ids: np.ndarray) -> None:
        n = self.filled[a, w]
        scores, ids = np.concatenate([self.scores[a, w, :n], scores]), np.concatenate([self.ids[a, w, :n], ids])
        best = np.lexsort((~ids, scores))[::-1][: self.k]
        self.filled[a, w] = n = len(best)
        self.scores[a, w, :n], self.ids[a, w, :n] = scores[best], ids[best]
        if n == self.k:
            self.floor[a, w] = max(self.floor[a, w], scores[best[-1]])

    def rows(self, anchors: Anchors) -> pa.RecordBatch:
        a, w, r = np.nonzero(np.arange(self.k) < self.filled[:, :, None])
        columns = [anchors.ids[a], w.astype(np.int32), self.scores[a, w, r], self.ids[a, w, r]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor_id", "slot", "score", "vec_id"])


def candidates(anchors: Anchors, a: int, block: Block) -> np.ndarray:
    """Rows of the block of the wanted labels, as indices."""
    start, stop = np.searchsorted(block.labels, anchors.labels[a], "left"), np.searchsorted(block.labels, anchors.labels[a], "right")
    rows = np.arange(start, stop) if anchors.same_label else np.concatenate([np.arange(start), np.arange(stop, len(block.ids))])
    return rows[block.ids[rows] != anchors.ids[a]]


def scan(anchors: Anchors, a: int, block: Block, best: Best) -> None:
    """Put the rows of the block that enter anchor ``a``'s windows into ``best``."""
    rows = candidates(anchors, a, block)
    wanted = np.flatnonzero(best.floor[a] <= anchors.upper[a])
    if not len(rows) or not len(wanted):
        return
    size = min(len(block.low), anchors.vectors.shape[1])
    q, low, high = anchors.vectors[a, :size], block.low[:size].astype(float), block.high[:size].astype(float)
    real = q.astype(float)
    if np.abs(real) @ np.maximum(np.abs(low), np.abs(high)) >= EXACT or block.columns.dtype != float:
        exact = [sum(x * y for x, y in zip(q.tolist(), c, strict=True)) for c in block.columns[:size, rows].T.astype(np.int64).tolist()]
        scores = np.array([min(max(s, LOWEST), HIGHEST) for s in exact], np.int64)
    else:
        order = np.argsort(-np.abs(real), kind="stable")
        ends = np.stack([np.minimum(real * low, real * high), np.maximum(real * low, real * high)])[:, order]
        # what the columns from each place of the order on can add, least and most
        left = np.flip(np.cumsum(np.flip(np.pad(ends, ((0, 0), (0, 1))), 1), axis=1), 1)
        partial, at = np.zeros(len(rows)), 0
        for stop in sorted({size, *(int(size * s) for s in STOPS)} - {0}):
            read, at = order[at:stop], stop
            if 2 * len(rows) > len(block.ids):
                partial += (real[read] @ block.columns[read])[rows]
            else:  # few left: only their places of a column are read
                partial += real[read] @ block.columns[np.ix_(read, rows)]
            least, most = left[:, stop].tolist()
            alive = np.zeros(len(rows), bool)
            for w in wanted:
                floor, upper = best.floor[a, w], anchors.upper[a, w]
                sure = partial[(partial + least >= floor) & (partial + most <= upper)]
                if len(sure) > anchors.k:
                    floor = max(floor, np.partition(sure, -anchors.k)[-anchors.k] + least)
                alive |= (partial + most >= floor) & (partial + least <= upper)
            if not alive.all():
                rows, partial = rows[alive], partial[alive]
            if not len(rows):
                return
        scores = partial.astype(np.int64)
    for w in wanted:
        inside = (scores >= best.floor[a, w]) & (scores <= anchors.upper[a, w])
        if inside.any():
            best.add(a, w, scores[inside], block.ids[rows[inside]])


def scan_blocks(blocks: DataFrame, anchors: Anchors) -> DataFrame:
    """The best rows of each task for each window."""
    sent = blocks.sparkSession.sparkContext.broadcast(anchors)  # CHUNK components, and its windows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        best = Best(asked)
        for batch in batches:
            for k in range(batch.num_rows):
                block = Block.of(batch.slice(k, 1).to_pylist()[0])
                for a in range(len(asked.ids)):
                    scan(asked, a, block, best)
        yield best.rows(asked)

    return blocks.mapInArrow(run, FOUND)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each window over all tasks, with their rank from 1."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(blocks: DataFrame, anchors: Anchors, scratch: Scratch, name: str) -> DataFrame:
    """(anchor_id, slot, score, vec_id, rank) of all windows."""
    seen = scratch.save(best_of(scan_blocks(blocks.filter("first"), anchors), anchors.k), f"{name}-first")
    worst = seen.filter(F.col("rank") == anchors.k).select("anchor_id", "slot", "score").toArrow()  # a row a window
    at = np.searchsorted(anchors.ids, worst["anchor_id"].to_numpy())
    raised = anchors.lower.copy()
    np.maximum.at(raised, (at, worst["slot"].to_numpy()), worst["score"].to_numpy())
    rest = Anchors(anchors.ids, anchors.labels, anchors.vectors, raised, anchors.upper, anchors.same_label, anchors.k)
    found = scan_blocks(blocks.filter("not first"), rest)
    return scratch.save(best_of(seen.drop("rank").unionByName(found), anchors.k), name)


def hard_negatives(
    rows: DataFrame, scratch: Scratch, asked: F.Column, positives: int = 5, negatives: int = 10,
    shares: tuple[int, int] = (30, 90), scale: float = 256, chunk: int = CHUNK,
) -> DataFrame:
    """Negatives of the rows (vec_id, label, embedding) that ``asked`` marks.

    Returned are anchor_id, positive_id, rank, negative_id, positive_score, negative_score and
    positive_rank; ``shares`` are per cent of the positive's score.
    """
    spark = rows.sparkSession
    taken = taking_part(rows)
    blocks = write_blocks(taken, scratch, scale)
    one = taken.filter(asked).groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("row"))
    one = scratch.save(one.select("vec_id", "row.*"), "anchors-all")
    n, widest = one.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    chunks = max(1, -(-n * max(widest or 1, positives * negatives) // chunk))
    anchors_by_chunk = scratch.save(one.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks))), "anchors", "chunk")
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank"]
    paths = []
    for c in range(chunks):
        own = anchors_by_chunk.filter(F.col("chunk") == c).select("vec_id", "label", "embedding").toArrow()  # a chunk
        own = own.sort_by("vec_id").combine_chunks()
        if not own.num_rows:
            continue
        ids, labels = own["vec_id"].to_numpy(), own["label"].to_numpy()
        vectors = integers(own["embedding"].combine_chunks(), scale)
        every = np.full((len(ids), 1), LOWEST), np.full((len(ids), 1), HIGHEST)
        near = search(blocks, Anchors(ids, labels, vectors, *every, True, positives), scratch, f"positives-{c}")
        near = near.select("anchor_id", (F.col("rank") - 1).alias("slot"), F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id"))
        known = near.toArrow()  # positives a anchor
        lower, upper = np.full((len(ids), positives), HIGHEST), np.full((len(ids), positives), LOWEST)
        at = np.searchsorted(ids, known["anchor_id"].to_numpy()), known["slot"].to_numpy()
        scores = known["positive_score"].to_pylist()
        lower[at], upper[at] = [-(-shares[0] * s // 100) for s in scores], [shares[1] * s // 100 for s in scores]
        far = search(blocks, Anchors(ids, labels, vectors, lower, upper, False, negatives), scratch, f"negatives-{c}")
        far = far.select("anchor_id", "slot", "rank", F.col("score").alias("negative_score"), F.col("vec_id").alias("negative_id"))
        told = far.join(near, ["anchor_id", "slot"]).withColumn("positive_rank", F.col("slot") + 1).select(*columns)
        scratch.save(told, f"told-{c}")
        paths.append(scratch.path(f"told-{c}"))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int"
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


ORACLE_SQL = """
with taken as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as e
  from {embeddings}
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
anchors as (select * from taken where vec_id % 100 = 0),
near as (
  select a.vec_id as anchor_id, a.label, a.e, t.vec_id as positive_id, list_inner_product(a.e, t.e)::bigint as positive_score,
         row_number() over (partition by a.vec_id order by positive_score desc, t.vec_id) as positive_rank
  from anchors a join taken t on t.label = a.label and t.vec_id <> a.vec_id
  qualify positive_rank <= 5
),
scored as (
  select a.vec_id as anchor_id, t.vec_id as negative_id, list_inner_product(a.e, t.e)::bigint as negative_score
  from anchors a join taken t on t.label <> a.label and t.vec_id <> a.vec_id
)
select anchor_id, positive_id,
       row_number() over (partition by anchor_id, positive_rank order by negative_score desc, negative_id)::integer as rank,
       negative_id, positive_score, negative_score, positive_rank::integer as positive_rank
from near join scored using (anchor_id)
where 30 * positive_score <= 100 * negative_score and 100 * negative_score <= 90 * positive_score
qualify rank <= 10
"""
