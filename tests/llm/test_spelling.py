"""Spelling variants against brute force over all pairs of words."""

import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import spelling
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.stage import table

from awkward import SF, awkward_texts, prose

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_words(rows, every):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return counts


def brute_variants(counts, shortest=6, least=5, ratio=5):
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    out, form = {}, {}
    for w, n in words.items():
        near = [v for v in words if one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
        out[w] = [form[w], None, n, len(near), words[form[w]] if form[w] else None]
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w][1] = root
    return {(w, *r) for w, r in out.items()}


def found(df):
    return [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = found(QUERIES["op12_spelling_variants"](spark, SF))
    assert len(got) == len(set(got)) and set(got) == brute_variants(brute_words(docs, 199))


def test_awkward_documents(spark, awkward, nothing, scratch):
    got = found(spelling.spelling_variants(awkward, scratch(), 3, 2, every=3))
    assert set(got) == brute_variants(brute_words(awkward_texts(), 3), 3, 2) and len(got) == len(set(got))
    assert spelling.spelling_variants(nothing, scratch()).count() == 0


def test_chains_ties_and_letters_beyond_ascii(spark, scratch):
    # counts that grow along a chain of edits, two forms of one count, multiplication sign and sharp s
    words = {"abcdef": 5, "abcdeg": 25, "abcdhg": 125, "abidhg": 700, "zzzzzé": 5, "zzzzzè": 30, "zzzzzê": 30, "stra×ße": 6, "straße": 40, "ÀBCDEF": 9}
    docs = spark.createDataFrame([(k, f"{w} " * n) for k, (w, n) in enumerate(words.items())], "doc_id long, text string")
    got = found(spelling.spelling_variants(docs, scratch()))
    assert set(got) == brute_variants(brute_words(docs.collect(), None))
    assert {r[0]: r[2] for r in got}["abcdef"] == "abidhg"


def test_one_reduced_word_for_many_words(spark, scratch):
    """Letters that share a symbol: all words have one key, and only near ones are kept."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    same = [c for c in letters if spark.range(1).select(spelling.reduced(F.lit(c))).first()[0] == spark.range(1).select(spelling.reduced(F.lit("a"))).first()[0]]
    assert len(same) > 1
    words = {a + b + c + "aaa" + d: 5 for a in same for b in same for c in same for d in same}
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    assert set(found(spelling.variants(rows, scratch()))) == brute_variants(words)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="abcé", min_size=1, max_size=5), min_size=1, max_size=30, unique=True))
def test_pairs_meet_once(spark, words):
    rows = spark.createDataFrame([(w, 1) for w in words], "word string, n long").coalesce(1)
    got = [(r["word"], r["near"]) for r in spelling.near_pairs(rows).collect()]
    assert sorted(got) == sorted((a, b) for a in words for b in words if one_edit(a, b))


@pytest.mark.parametrize("text", [prose(3, 4000, 30)])
def test_a_very_long_run(spark, scratch, text):
    run = text.replace(" ", "")
    docs = spark.createDataFrame([(1, run), (2, run), (3, run), (4, run), (5, run + "x"), (6, run)], "doc_id long, text string")
    got = found(spelling.spelling_variants(docs, scratch(), least=1))
    assert {(len(r[0]), r[3], r[4]) for r in got} == {(len(run), 5, 1), (len(run) + 1, 1, 1)}
