"""Line deduplication against plain Python and its SQL."""

from collections import Counter, defaultdict

import duckdb

from awkward import SF, awkward_texts
from ledgerloom.llm import line_dedup
from ledgerloom.llm.queries import ORACLES, QUERIES

WHITE = " \t\n\x0b\x0c\r"


def fold(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def expected(rows, least=20, documents=3):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(fold(line)) >= least:
                holders[fold(line)].add(-(1 << 63) if doc is None else doc)
    out = Counter()
    for doc, text in rows:
        lines = (text or "").split("\n")
        own = -(1 << 63) if doc is None else doc
        kept = [x for x in lines if len(holders.get(fold(x), ())) < documents or max(holders[fold(x)]) == own]
        out[doc, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    return out


def found(df):
    return Counter((r["doc_id"], r["text"] or "", r["n_lines"], r["n_dropped"]) for r in df.collect())


def test_awkward_documents(awkward, scratch, nothing):
    got = line_dedup.dedup_lines(awkward, scratch())
    assert found(got) == expected(awkward_texts())
    assert got.columns == [*(c for c in awkward.columns if c != "n_lines"), "n_lines", "n_dropped"]
    assert {(r["rest"], r["key"], r["doc"], r["label"]) for r in got.collect()} == {("r", "k", "d", 1)}
    assert line_dedup.dedup_lines(nothing, scratch()).count() == 0


def test_levels_do_not_change_the_result(awkward, scratch):
    for batches, fanout in ((1, 2), (5, 2), (4, 9)):
        got = line_dedup.dedup_lines(awkward, scratch(), batches=batches, fanout=fanout)
        assert found(got) == expected(awkward_texts())


def test_a_hot_line(spark, scratch):
    rows = [(k, f"a line that half of all documents hold\nline {k} is held by nobody else" if k % 2 else f"nothing shared in {k}") for k in range(600)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), scratch(), batches=2)
    assert found(got) == expected(rows)


def test_query_equals_its_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = QUERIES["op1_line_dedup"](spark, SF)
    columns = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    rows = db.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES['op1_line_dedup']})").fetchall()
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(rows)


def test_a_batch_is_written_by_one_job(spark, awkward, scratch, monkeypatch):
    """Each job writes a file a bucket, so the keys of a batch and its repeats are one table."""
    made, bucketed = [], line_dedup.LineRuns._bucketed
    monkeypatch.setattr(line_dedup.LineRuns, "_bucketed", lambda self, rows: made.append(bucketed(self, rows)) or made[-1])
    work = scratch()
    saved, save = [], work.save
    monkeypatch.setattr(work, "save", lambda df, name, *by: saved.append(name) or save(df, name, *by))
    got = line_dedup.dedup_lines(awkward, work, batches=4, fanout=9)
    assert found(got) == expected(awkward_texts())
    assert len(made) == 4 + 1  # batches, and all their repeats together
    assert saved == ["lines", "decisions"]
