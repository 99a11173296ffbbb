"""The quality discriminant: statistics, densities, held-out accuracy, awkward documents."""

import zlib

import numpy as np
import pyarrow as pa

from ledgerloom.llm import quality
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.stage import Scratch, table

from awkward import awkward_texts

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


def plain_statistics(text):
    """The same numbers, character by character."""
    text = text or ""
    count = {k: 0 for k in ("lower", "upper", "digit", "stop", "mark", "symbol", "wide")}
    for c in text:
        if c in " \t\n\v\f\r":
            continue
        kind = (
            "wide" if ord(c) > 127 else "lower" if "a" <= c <= "z" else "upper" if "A" <= c <= "Z" else "digit" if c.isdigit()
            else "stop" if c in ".,;:'\"()-" else "mark" if c in "!?" else "symbol"
        )
        count[kind] += 1
    seen, letters = sum(count.values()), count["lower"] + count["upper"] + count["wide"]
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text).split(" ") if w]
    n, few = len(words), quality.FEW
    share = lambda part, whole, few: np.log(part / (whole + few) + quality.LEAST)
    return [
        np.log1p(n), np.log1p(len(set(words))), np.log((seen + 5 * few) / (n + few)), share(count["upper"], letters, 5 * few),
        *(share(count[k], seen, 5 * few) for k in ("digit", "stop", "mark", "symbol", "wide")),
        share(sum(a == b for a, b in zip(words, words[1:])), n, few),
        share(sum(len(w.encode()) <= 2 for w in words) + few / 5, n, few), np.log1p(n) - np.log1p(text.count("\n")),
    ]


def plain_scores(docs, labels, towards_pooled=0.2, towards_diagonal=0.02):
    """Scores by densities with explicit inverses and determinants."""
    x = {i: np.array(plain_statistics(t)) for i, t in docs}
    learned = {i: y for i, y in labels.items() if i in x and zlib.crc32(str(i).encode()) % 5}
    parts = [np.array([x[i] for i, y in learned.items() if y == k]) for k in (0, 1)]
    pooled = sum((p - p.mean(0)).T @ (p - p.mean(0)) for p in parts) / len(learned)
    out = []
    for p in parts:
        c = (1 - towards_pooled) * np.cov(p.T, bias=True) + towards_pooled * pooled
        c = (1 - towards_diagonal) * c + towards_diagonal * np.diag(np.maximum(np.diag(pooled), 1e-6))
        inverse, logdet = np.linalg.inv(c), np.linalg.slogdet(c)[1]
        out.append({i: -((v - p.mean(0)) @ inverse @ (v - p.mean(0)) + logdet) / 2 + np.log(len(p)) for i, v in x.items()})
    return {i: 1 / (1 + np.exp(np.clip(out[0][i] - out[1][i], -500, 500))) for i in x}


def test_statistics_of_each_text():
    texts = [t for _, t in awkward_texts()] + ["A a a!! B\nb | 12 é\v\fé", "x"]
    got = quality.statistics(pa.array([t or "" for t in texts]))
    assert np.allclose(got, [plain_statistics(t) for t in texts])
    assert quality.statistics(pa.array([], pa.string())).shape == (0, len(quality.NAMES))


def test_scores_equal_plain_densities(spark):
    docs = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SMALL, "labels").collect()}
    expected = plain_scores(docs, labels)
    rows = QUERIES["op11_quality"](spark, SMALL).collect()
    assert len(rows) == len(docs) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.allclose([r["score"] for r in rows], [expected[r["doc_id"]] for r in rows], atol=1e-6)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    held = [(labels[r["doc_id"]], r["predicted"]) for r in QUERIES["op11_quality"](spark, SF).collect() if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == 0 for y, p in held if y == 0]) > 0.95 and np.mean([p for y, p in held if y]) > 0.99


def test_awkward_documents_and_labels(spark, awkward, nothing):
    labels = spark.createDataFrame([(5, 1), (6, 0), (None, 1), (7, None), (9, 0), (9, 1), (999, 1), (13, 7)], "doc_id long, quality int")

    def trained(docs, known):
        return quality.train(Scratch(spark, "quality").save(quality.with_statistics(docs), "statistics"), known)

    model = trained(awkward, labels)
    scored = quality.score(awkward, model)
    assert scored.count() == len(awkward_texts()) and scored.filter("score is null or score < 0 or score > 1").count() == 0
    assert scored.columns == [*(c for c in awkward.columns if c != "score"), "score", "predicted"]
    one_class = trained(awkward, labels.filter("quality = 1"))
    assert {r["score"] for r in quality.score(awkward, one_class).collect()} == {1.0}
    assert trained(nothing, labels).share == 0.0 and quality.score(nothing, model).count() == 0
