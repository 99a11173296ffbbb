"""Quality: a regularised quadratic discriminant on statistics of documents.

A document becomes a few logarithms: its length, its words' length and variety, the shares of
kinds of characters and of words that repeat the one before. Each class of the label is a
normal distribution over them. Its covariance is shrunk towards the covariance of both
(``towards_pooled``) and that towards a diagonal (``towards_diagonal``), so it can be factored
however few documents a class has. A score is the probability of label 1: the difference of
the two log densities, from Mahalanobis distances by the classes' Cholesky factors, which the
model keeps, and the log ratio of the classes' shares.

The statistics of all documents are computed in one pass over the texts and written; moments
of the classes are sums over all labelled documents that aren't held out, no sample. Only
rows of statistics are shuffled, to meet their labels.

Defined results: null and empty texts have the statistics of no words; labels that are null,
not 0 or 1, or belong to no document are not learned; of repeated labels the largest counts, a
row of documents that repeats is learned again; with no label of one class every score is
the share of label 1 (0 without any); an empty table gives no rows; columns other than doc_id
and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from ledgerloom.llm.stage import distinct, mapped, packed, texts_of, unpacked, utf8

LOWER, UPPER, DIGIT, SPACE, LINE, STOP, MARK, SYMBOL, WIDE, TAIL = range(10)
NAMES = ("words", "distinct words", "word length", "upper case", "digits", "stops", "marks", "symbols", "not ASCII",
         "repeats of the word before", "words of a letter or two", "words a line")
LEAST = 0.01  # added to a share before its logarithm: a stray character moves it little,
FEW = 10  # and so many words (five characters each) are added to what it is a share of


def _kinds() -> np.ndarray:
    kinds = np.full(256, SYMBOL, np.uint8)
    kinds[97:123], kinds[65:91], kinds[48:58] = LOWER, UPPER, DIGIT
    kinds[[9, 11, 12, 13, 32]], kinds[10] = SPACE, LINE
    kinds[[ord(c) for c in ".,;:'\"()-"]], kinds[[ord(c) for c in "!?"]] = STOP, MARK
    kinds[128:192], kinds[192:] = TAIL, WIDE  # the later bytes of a character, and the first one
    return kinds


_KINDS = _kinds()


def _counts(texts: pa.StringArray) -> np.ndarray:
    """Characters of each kind, a row for each text."""
    data, offsets = utf8(texts)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32) * len(range(TAIL + 1)), np.diff(offsets))
    return np.bincount(owner + _KINDS[data], minlength=len(texts) * (TAIL + 1)).reshape(len(texts), TAIL + 1)


def statistics(texts: pa.StringArray) -> np.ndarray:
    """A row of ``NAMES`` for each text."""
    n = len(texts)
    if not n:
        return np.zeros((0, len(NAMES)))
    kinds = _counts(texts)
    split = pc.ascii_split_whitespace(texts)
    owner, words = pc.list_parent_indices(split).to_numpy(), pc.list_flatten(split)
    size = pc.binary_length(words).to_numpy(zero_copy_only=False)
    code = words.dictionary_encode().indices.to_numpy()
    owner, code, size = (x[size > 0] for x in (owner, code, size))
    count = np.bincount(owner, minlength=n)
    unlike = np.bincount(distinct((owner.astype(np.int64) << 32) | code) >> 32, minlength=n)
    again = np.bincount(owner[1:][(code[1:] == code[:-1]) & (owner[1:] == owner[:-1])], minlength=n)
    short = np.bincount(owner[size <= 2], minlength=n)
    seen = kinds[:, [LOWER, UPPER, DIGIT, STOP, MARK, SYMBOL, WIDE]].sum(axis=1)

    def share(part: np.ndarray, whole: np.ndarray, few: int = 5 * FEW) -> np.ndarray:
        return np.log(part / (whole + few) + LEAST)

    letters = kinds[:, LOWER] + kinds[:, UPPER] + kinds[:, WIDE]
    return np.column_stack([
        np.log1p(count), np.log1p(unlike), np.log((seen + 5 * FEW) / (count + FEW)),
        share(kinds[:, UPPER], letters), *(share(kinds[:, k], seen) for k in (DIGIT, STOP, MARK, SYMBOL, WIDE)),
        share(again, count, FEW), share(short + FEW / 5, count, FEW), np.log1p(count) - np.log1p(kinds[:, LINE]),
    ])


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics) of all documents."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = statistics(texts_of(batch.column(1)))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES)), pa.array(x.ravel()))
        return pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "statistics"])

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, statistics array<double>")


@dataclass
class Model:
    """Means, inverses of the Cholesky factors and log determinants of the classes 0 and 1, and
    the log ratio of their shares; or a share alone if a class is missing."""

    means: np.ndarray
    factors: np.ndarray
    logdets: np.ndarray
    prior: float
    share: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.share is not None:
            return np.full(len(x), self.share)
        far = [((x - self.means[k]) @ self.factors[k].T) ** 2 for k in (0, 1)]  # Mahalanobis distances, by component
        z = (far[0].sum(axis=1) + self.logdets[0] - far[1].sum(axis=1) - self.logdets[1]) / 2 + self.prior
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(n: np.ndarray, sums: np.ndarray, squares: np.ndarray, towards_pooled: float, towards_diagonal: float) -> Model:
    """The model of the classes' numbers of documents, sums of statistics and of their products."""
    if not n.all():
        return Model(np.zeros(0), np.zeros(0), np.zeros(0), 0.0, float(n[1] / n.sum()) if n.sum() else 0.0)
    means = sums / n[:, None]
    scatter = squares - n[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(axis=0) / n.sum()
    own = scatter / n[:, None, None]
    mixed = (1 - towards_pooled) * own + towards_pooled * pooled
    spread = np.diag(np.maximum(np.diag(pooled), 1e-6))
    mixed = (1 - towards_diagonal) * mixed + towards_diagonal * spread
    lower = np.linalg.cholesky(mixed)
    logdets = 2 * np.log(np.diagonal(lower, axis1=1, axis2=2)).sum(axis=1)
    return Model(means, np.linalg.inv(lower), logdets, float(np.log(n[1] / n[0])))


def held_out(doc_id: F.Column) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(rows: DataFrame, labels: DataFrame, towards_pooled: float = 0.2, towards_diagonal: float = 0.02) -> Model:
    """Fit on the labels (doc_id, quality) of the documents that aren't held out.

    ``rows`` are what ``with_statistics`` gives, written, as they are read again.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(NAMES))
        y = batch.column(0).to_numpy()
        with_one = np.column_stack([np.ones(len(x)), x])
        products = np.stack([with_one[y == k].T @ with_one[y == k] for k in (0, 1)])
        place = np.arange(products.size, dtype=np.int32)
        return pa.RecordBatch.from_arrays([pa.array(place), pa.array(products.ravel())], names=["place", "value"])

    moments = mapped(rows.join(known, "doc_id").select("quality", "statistics"), add, "place int, value double")
    total = np.zeros((2, len(NAMES) + 1, len(NAMES) + 1))
    for r in moments.groupBy("place").agg(F.sum("value").alias("value")).collect():  # two matrices of the statistics
        total.ravel()[r["place"]] = r["value"]
    return fit(total[:, 0, 0], total[:, 0, 1:], total[:, 1:, 1:], towards_pooled, towards_diagonal)


def _predictions(scores: np.ndarray, least: float) -> list[pa.Array]:
    return [pa.array(scores), pa.array((scores >= least).astype(np.int32))]


def score_statistics(rows: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) of what ``with_statistics`` gives."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(NAMES))
        return pa.RecordBatch.from_arrays([batch.column(0), *_predictions(model.scores(x), least)], names=["doc_id", "score", "predicted"])

    return mapped(rows.select("doc_id", "statistics"), run, "doc_id long, score double, predicted int")


def score(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, which replace columns of these names."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _predictions(model.scores(statistics(texts_of(batch.column(1)))), least)
        return pa.RecordBatch.from_arrays([*batch.columns, *found], ["doc_id", "text", "rest", "score", "predicted"])

    rows = packed(docs, "doc_id", "text", without=("score", "predicted"))
    schema = StructType([*rows.schema.fields]).add("score", DoubleType()).add("predicted", IntegerType())
    return unpacked(mapped(rows, run, schema), "doc_id", "text", "score", "predicted")
