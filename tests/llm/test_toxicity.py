"""The toxicity classifier: features, held-out accuracy, awkward documents."""

import zlib

import numpy as np
import pyarrow as pa

from awkward import awkward_texts
from ledgerloom.llm import toxicity
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.stage import table

SF = "/root/testdata/sf0.1"


def test_ngrams_stay_inside_their_text():
    together = toxicity.ngrams(pa.array(["Abcdé  f", "", "abcd", "x"]))
    for k, text in enumerate(["abcdé f", "", "abcd", "x"]):
        _, alone = toxicity.ngrams(pa.array([text]))
        assert sorted(together[1][together[0] == k].tolist()) == sorted(alone.tolist())
        grams = {text[i : i + n] for n in toxicity.SIZES for i in range(len(text) - n + 1)}
        assert len(alone) == len(grams)


def test_logistic_regression_finds_the_signal():
    r = np.random.default_rng(0)
    x = r.random((500, 30)) < 0.3
    y = (x[:, 3] | x[:, 7]).astype(float)
    rows, columns = np.nonzero(x)
    indptr = np.searchsorted(rows, np.arange(501))
    w, b = toxicity.fit_logistic(indptr, columns, np.ones(30), y, np.ones(500))
    assert (((x @ w + b) > 0) == y).mean() > 0.95 and set(np.argsort(-w)[:2]) == {3, 7}


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    rows = QUERIES["op9_toxicity"](spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    bad = [p for y, p in held if y]
    good = [p for y, p in held if not y]
    assert np.mean(bad) > 0.85 and np.mean(good) < 0.01  # a twentieth of the toxic labels marks ordinary texts


def test_awkward_documents_and_labels(spark, awkward, nothing):
    labels = spark.createDataFrame([(5, 1), (6, 0), (None, 1), (7, None), (10, 0), (10, 1), (999, 1)], "doc_id long, toxic int")
    model = toxicity.train(awkward, labels, least_documents=1)
    scored = toxicity.score(awkward, model)
    assert scored.count() == len(awkward_texts()) and scored.filter("score is null").count() == 0
    assert scored.columns == [*(c for c in awkward.columns if c != "score"), "score", "predicted"]
    one_class = toxicity.train(awkward, labels.filter("toxic = 0"))
    assert {r["predicted"] for r in toxicity.score(awkward, one_class).collect()} == {0}
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.train(nothing, labels).intercept in (-500.0, 500.0)
