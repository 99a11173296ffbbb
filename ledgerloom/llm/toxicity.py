"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the hashed n-grams (4 to 7 characters, lower case) that it holds, white
space runs as one space. The log-count ratio of a feature compares the share of toxic
documents that hold it with that of clean ones; logistic regression is fitted on the ratios of
the features present. Score: the regression's probability.

Labels are learned from at most ``per_class`` documents a class, chosen by a hash of doc_id,
and weighted back to the classes' true shares; the ``features`` features of the strongest
ratios among those in ``least_documents`` documents are kept. Every document is scored, over
its whole text.

Defined results: null and empty texts have no features and get the score of the intercept;
labels that are null or belong to no document are not learned; of repeated labels the largest
counts; with no label of one class every score is the share of toxic labels (0 without any);
an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from ledgerloom.llm.chunks import forget_tables
from ledgerloom.llm.stage import distinct, mapped, packed, texts_of, unpacked

BITS = 20
SIZES = (4, 5, 6, 7)


def ngrams(texts: pa.StringArray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once: hashed n-grams, or what ``wanted`` maps their hashes
    to where that isn't negative."""
    texts = pc.replace_substring_regex(pc.utf8_lower(texts), r"\s+", " ")
    bounds = np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))]).astype(np.int64)
    joined = "".join(texts.to_pylist())
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    found, rolling = [], points.copy()
    for n in range(2, max(SIZES) + 1):
        if len(points) < n:
            break
        rolling = rolling[: len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1 :]
        if n not in SIZES:
            continue
        hashed = (rolling * np.uint32(0x9E3779B1) ^ (rolling >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
        hashed >>= np.uint32(32 - BITS)
        inside = owner[: len(hashed)] == owner[n - 1 :]
        if wanted is not None:
            mapped_to = wanted[hashed]
            inside &= mapped_to >= 0
            at = np.flatnonzero(inside)
            found.append((owner[at] << BITS) | mapped_to[at])
        else:
            at = np.flatnonzero(inside)
            found.append((owner[at] << BITS) | hashed[at])
    pairs = distinct(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


@dataclass
class Model:
    """``index`` maps hashes to weights (-1: none)."""

    index: np.ndarray
    weights: np.ndarray
    intercept: float

    def scores(self, texts: pa.StringArray) -> np.ndarray:
        owner, feature = ngrams(texts, self.index)
        z = np.bincount(owner, self.weights[feature], minlength=len(texts)) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_logistic(indptr: np.ndarray, columns: np.ndarray, scale: np.ndarray, y: np.ndarray, weight: np.ndarray,
                 penalty: float = 1e-4, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weighted logistic regression with a ridge penalty, by accelerated gradient steps."""
    rows = np.repeat(np.arange(len(y)), np.diff(indptr))
    values, weight = scale[columns], weight / weight.sum()
    w, b = np.zeros(len(scale)), 0.0
    ahead, ahead_b, t = w.copy(), b, 1.0
    norms = np.bincount(rows, values**2, minlength=len(y)) + 1
    step = 4 / (np.sum(weight * norms) + 4 * penalty)
    for _ in range(rounds):
        z = np.bincount(rows, values * ahead[columns], minlength=len(y)) + ahead_b
        error = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
        gradient = np.bincount(columns, values * error[rows], minlength=len(scale)) + penalty * ahead
        new, new_b = ahead - step * gradient, ahead_b - step * error.sum()
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        pull = (t - 1) / after
        ahead, ahead_b = new + pull * (new - w), new_b + pull * (new_b - b)
        w, b, t = new, new_b, after
    return w * scale, b


def held_out(doc_id: F.Column) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, per_class: int = 6000, features: int = 2048, least_documents: int = 10) -> Model:
    """Fit on the labels (doc_id, toxic) of documents that aren't held out."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    shares = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    empty = Model(np.full(1 << BITS, -1, np.int32), np.zeros(0), 0.0)
    if len(shares) < 2:
        empty.intercept = 500.0 if 1 in shares else -500.0
        return empty
    order = (F.xxhash64("doc_id"), "doc_id")
    toxic = known.filter("toxic = 1").orderBy(*order).limit(per_class)
    sample = toxic.unionByName(known.filter("toxic = 0").orderBy(*order).limit(per_class))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")  # bounded by per_class
    rows = rows.select("text", "toxic")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        forget_tables()
        y = batch.column(1).to_numpy().astype(bool)
        owner, feature = ngrams(texts_of(batch.column(0)))
        n, bad = np.bincount(feature), np.bincount(feature[y[owner]])
        seen = np.flatnonzero(n)
        bad = np.pad(bad, (0, len(n) - len(bad)))[seen]
        return pa.RecordBatch.from_arrays([pa.array(seen), pa.array(bad), pa.array(n[seen] - bad)], ["feature", "bad", "good"])

    n = rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    n = {r["toxic"]: r["n"] for r in n}
    if len(n) < 2:
        empty.intercept = 500.0 if 1 in n else -500.0
        return empty
    counts = mapped(rows, count, "feature long, bad long, good long").groupBy("feature").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")
    )
    ratio = F.log(((F.col("bad") + 1) / (n[1] + 2)) / ((F.col("good") + 1) / (n[0] + 2)))
    counts = counts.filter(F.col("bad") + F.col("good") >= least_documents).withColumn("ratio", ratio)
    # strong and seldom by chance: the ratio in units of its own spread
    spread = F.sqrt(1 / (F.col("bad") + 1) + 1 / (F.col("good") + 1))
    kept = counts.orderBy(F.desc(F.abs(F.col("ratio")) / spread), "feature").limit(features).select("feature", "ratio").collect()
    index = np.full(1 << BITS, -1, np.int32)
    for k, r in enumerate(kept):
        index[r["feature"]] = k
    scale = np.array([r["ratio"] for r in kept])

    def design(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, feature = ngrams(texts_of(batch.column(0)), index)
        bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(feature.astype(np.int32)))
        return pa.RecordBatch.from_arrays([batch.column(1), lists], ["toxic", "features"])

    table = mapped(rows, design, "toxic int, features array<int>").toArrow()  # at most two per_class rows
    lists = table["features"].combine_chunks()
    indptr = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    y = table["toxic"].to_numpy().astype(float)
    weight = np.where(y == 1, shares[1] / n[1], shares[0] / n[0])
    weights, intercept = fit_logistic(indptr, lists.flatten().to_numpy(), scale, y, weight)
    return Model(index, weights, intercept)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, which replace columns of these names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS numbers and the weights

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        forget_tables()
        scores = sent.value.scores(texts_of(batch.column(1)))
        columns = [*batch.columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "rest", "score", "predicted"])

    rows = packed(docs, "doc_id", "text", without=("score", "predicted"))
    schema = StructType([*rows.schema.fields]).add("score", DoubleType()).add("predicted", IntegerType())
    return unpacked(mapped(rows, run, schema), "doc_id", "text", "score", "predicted")
