"""The pipeline on the smallest scale: each stage against plain Python on its own input."""

from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from awkward import SF, awkward_texts
from ledgerloom.llm.stage import Scratch, table
from ledgerloom.sources.workspace import intermediates
from test_line_dedup import expected as deduped_lines
from test_near_documents import brute_classes, repeated_words
from test_tokens import check_packing


@pytest.fixture(scope="module")
def stages(spark):
    scratch, docs = Scratch(spark, "test"), table(spark, SF, "documents")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.save(stage(spark, docs, SF), name)
        out[name] = docs
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert all(stages[n].columns == stages["documents"].columns for n in names[:-1])


def test_toxic_documents_go_and_others_stay(stages, spark):
    before, after = texts(stages["documents"]), texts(stages["toxicity"])
    toxic = {r["doc_id"] for r in table(spark, SF, "labels").filter("toxic = 1").collect()}
    clean = {r["doc_id"] for r in table(spark, SF, "labels").filter("toxic = 0").collect()}
    assert after.items() <= before.items() and clean <= set(after)
    assert len(toxic & set(after)) <= 0.4 * len(toxic)


def test_lines(stages):
    before, after = texts(stages["toxicity"]), texts(stages["line_dedup"])
    assert Counter(after.items()) == Counter({(i, t): n for (i, t, _, _), n in deduped_lines(before.items()).items()})
    assert all(r["n_chars"] == len(r["text"]) for r in stages["line_dedup"].collect())


def test_one_of_each_group(stages):
    before, after = texts(stages["line_dedup"]), texts(stages["minhash_near_dedup"])
    classes = brute_classes(before.items())
    assert after == {i: t for i, t in before.items() if classes[i] == i}


def test_passages(stages):
    before, after = texts(stages["minhash_near_dedup"]), texts(stages["substring_dedup"])
    assert set(after) == set(before)
    need = repeated_words(before.items())
    assert all(len(after[i].split()) < len(before[i].split()) for i in need)
    assert not repeated_words(after.items())


def test_packing(stages):
    docs = list(texts(stages["substring_dedup"]).items())
    assert check_packing(stages["best_fit_packing"].collect(), docs, 4096) >= 1


def test_awkward_documents_pass_all_stages(spark, awkward):
    own = "score string, predicted int, rest string, `a.b` int, _dropped string, n_lines string, spans string"  # the stages' names
    rows = [(i, t, "en", "s", 0, "s", 7, "r", 2, "x", "n", "p") for i, t in awkward_texts()]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {own}")
    scratch, columns = Scratch(spark, "test"), docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.save(stage(spark, docs, SF), name)
        if name != "best_fit_packing":
            assert docs.columns == columns
            assert {tuple(r) for r in docs.select("score", "predicted", "rest", "`a.b`", "n_lines").collect()} == {("s", 7, "r", 2, "n")}
    assert docs.count() > 0
    empty = stages_of_nothing(spark)
    assert empty.count() == 0


def stages_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    scratch = Scratch(spark, "test")
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.save(stage(spark, docs, SF), name)
    return docs


def test_registered():
    names = set(queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert "op1_line_dedup" in oracle_sql()


def test_stages_go_with_their_scope(spark):
    with intermediates(spark):
        scratch = Scratch(spark, "test")
        scratch.save(spark.range(3), "rows")
        folder = Path(scratch.folder.removeprefix("file:"))
        assert folder.exists()
    assert not folder.exists()
