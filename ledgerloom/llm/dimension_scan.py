"""Approximate nearest neighbours by an adaptive dimension scan over inverted lists.

Vectors are scaled to length one, turned by a random rotation and put into the list of the
nearest of ``lists`` centroids. A query probes the ``probes`` nearest lists. In each, the
components are read in column blocks: after every block a hypothesis test compares the
distance that the components seen so far suggest with the query's current limit (its k-th
nearest so far), and candidates that fail are abandoned. The rest are scored by cosine in
double precision on the original vectors. Long lists and many queries are dealt into blocks,
so no list is gathered in one task.

The centroids are fitted on at most ``sample`` vectors, chosen by a hash of vec_id; every
vector is indexed.

Defined results: vectors that are null, zero, or hold null or non-finite components, and null
vec_ids, take no part; ties go to the smaller vec_id; rows that repeat a vec_id count once,
with the best score; fewer candidates than ``k`` are all returned if their lists are probed;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.stage import Scratch, mapped
from ledgerloom.llm.vectors import dimension, matrix, rotation, scaled, taking_part, units

SEED = 20240731
COLUMNS = 16  # components a block
TEST = 2.1  # standard deviations; larger abandons less
UNIT = "list int, block int, queries int, is_query boolean, vec_id long, embedding array<double>"


def fit_centroids(x: np.ndarray, lists: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means on unit vectors; a list that empties keeps its centroid."""
    random = np.random.default_rng(SEED)
    centroids = x[random.permutation(len(x))[:lists]]
    for _ in range(rounds):
        near = (x @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centroids)
    return centroids


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    x, query = scaled(x), scaled(query[None])[0]
    dots = (x * query).sum(axis=1)
    return dots / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((query * query).sum()))


def scan(turned: np.ndarray, query: np.ndarray, k: int) -> np.ndarray:
    """Rows of ``turned`` that may be among the ``k`` nearest of a rotated query."""
    size, first = turned.shape[1], min(len(turned), 8 * k)
    distances = ((turned[:first] - query) ** 2).sum(axis=1)
    limit = np.partition(distances, k - 1)[k - 1] if first >= k else np.inf
    alive, partial = np.arange(len(turned)), np.zeros(len(turned))
    for start in range(0, size, COLUMNS):
        end = min(start + COLUMNS, size)
        partial = partial + ((turned[alive, start:end] - query[start:end]) ** 2).sum(axis=1)
        if end < size:
            passed = partial * (size / end) <= (1 + TEST / np.sqrt(end)) ** 2 * limit
        else:
            passed = partial <= limit + 1e-9
        alive, partial = alive[passed], partial[passed]
    return alive


def nearest(
    vectors: DataFrame,
    scratch: Scratch,
    is_query: F.Column,
    k: int = 5,
    lists: int = 64,
    probes: int = 44,
    sample: int = 20_000,
    block: int = 4096,
    query_block: int = 512,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the ``k`` nearest found for each query row of
    ``vectors`` (vec_id, embedding); a query is no candidate of its own."""
    spark = vectors.sparkSession
    rows = vectors.filter(taking_part("embedding") & F.col("vec_id").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), is_query.alias("is_query"))
    size = dimension(rows, "embedding")
    schema = "query_id long, rank int, vec_id long, score double"
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").toArrow()
    if not chosen.num_rows:
        return spark.createDataFrame([], schema)
    centroids = fit_centroids(unit_rows(matrix(chosen["embedding"].combine_chunks(), size)), lists)
    lists = len(centroids)

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        near = unit_rows(matrix(batch.column(1), size)) @ centroids.T
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.argmax(axis=1).astype(np.int32))], [*batch.schema.names, "list"])

    base = "vec_id long, embedding array<double>, is_query boolean, list int"
    placed = scratch.save(mapped(rows, place, base), "placed")
    counts = placed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()  # a row a list
    parts = np.ones(lists, int)
    for r in counts:
        parts[r["list"]] = -(-r["n"] // block)
    n_queries = placed.filter("is_query").count()
    query_parts = max(1, -(-n_queries * probes // (lists * query_block)))

    def probe(batch: pa.RecordBatch) -> pa.RecordBatch:
        near = unit_rows(matrix(batch.column(1), size)) @ centroids.T
        best = np.argsort(-near, axis=1, kind="stable")[:, :probes]
        query, found = np.repeat(np.arange(len(best)), best.shape[1]), best.ravel()
        each = parts[found]
        query, found = np.repeat(query, each), np.repeat(found, each)
        blocks = np.arange(len(found)) - np.repeat(np.cumsum(each) - each, each)
        columns = [pa.array(found.astype(np.int32)), pa.array(blocks.astype(np.int32))]
        columns += [batch.column(0).take(pa.array(query)), batch.column(1).take(pa.array(query))]
        return pa.RecordBatch.from_arrays(columns, ["list", "block", "vec_id", "embedding"])

    list_parts = F.array(*(F.lit(int(p)) for p in parts))
    own_block = F.pmod(F.xxhash64("vec_id"), F.element_at(list_parts, F.col("list") + 1)).cast("int")
    every_part = F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1)))
    candidates = placed.select("list", own_block.alias("block"), every_part.alias("queries"), F.lit(False).alias("is_query"), "vec_id", "embedding")
    asked = mapped(placed.filter("is_query").select("vec_id", "embedding"), probe, "list int, block int, vec_id long, embedding array<double>")
    own_part = F.pmod(F.xxhash64("vec_id"), F.lit(query_parts)).cast("int")
    asked = asked.select("list", "block", own_part.alias("queries"), F.lit(True).alias("is_query"), "vec_id", "embedding")
    keys = ("list", "block", "queries")
    dealt = candidates.unionByName(asked).repartition(*keys).sortWithinPartitions(*keys)
    found = dealt.mapInArrow(_scan_units(size, k), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _scan_units(size: int, k: int):
    turn = rotation(size, SEED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in units(batches, 3):
            asking = unit["is_query"].to_numpy()
            ids, x = unit["vec_id"].to_numpy(), matrix(unit["embedding"].combine_chunks(), size)
            own_ids, own = ids[~asking], x[~asking]
            if not asking.any() or not len(own):
                continue
            turned, queries, scores, names = unit_rows(own) @ turn, [], [], []
            for query_id, query, q in zip(ids[asking], x[asking], unit_rows(x[asking]) @ turn, strict=True):
                # one more than asked for, and all ties, as the query itself may be among them
                alive = scan(turned, q, k + 1)
                alive = alive[own_ids[alive] != query_id]
                score = cosines(own[alive], query)
                best = np.lexsort((own_ids[alive], -score))
                _, first = np.unique(own_ids[alive][best], return_index=True)
                best = best[np.sort(first)][:k]
                queries.append(np.full(len(best), query_id))
                names.append(own_ids[alive][best])
                scores.append(score[best])
            columns = [np.concatenate(c) for c in (queries, names, scores)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    return run
