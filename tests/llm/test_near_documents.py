"""Alignment, order min-hash classes and repeated passages against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from awkward import SF, awkward_texts, prose
from ledgerloom.llm import compact_windows, order_minhash, words
from ledgerloom.llm.alignment import banded_distance, similar
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.stage import table


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return row[-1]


sequence = st.lists(st.integers(0, 4), max_size=25)


@settings(max_examples=400, deadline=None)
@given(sequence, sequence, st.integers(0, 12))
def test_banded_distance(a, b, band):
    exact = distance(a, b)
    assert banded_distance(np.array(a, int), np.array(b, int), band) == (exact if exact <= band else None)


@given(st.lists(st.text(alphabet="aB é\n\t", max_size=12), max_size=6))
def test_words(texts):
    hashes, bounds = words.word_hashes(pa.array(texts, pa.string()))
    split = [[w for w in t.lower().replace("\t", " ").replace("\n", " ").split(" ") if w] for t in texts]
    assert np.diff(bounds).tolist() == [len(w) for w in split]
    by_word = dict(zip((w for ws in split for w in ws), hashes.tolist()))
    assert [by_word[w] for ws in split for w in ws] == hashes.tolist() and len(set(by_word.values())) == len(by_word)


def test_sketch_keeps_order_and_occurrences():
    r = random.Random(1)
    text = [r.randrange(1 << 60) for _ in range(300)]
    moved = text[150:] + text[:150]
    kmers = [order_minhash.labelled_kmers(np.array(t, np.uint64)) for t in (text, text, moved, text + text)]
    assert len(set(kmers[3].tolist())) == len(kmers[3])  # repeats have labels of their own
    bounds = np.cumsum([0] + [len(k) for k in kmers])
    keys = order_minhash.sketch_keys(np.concatenate(kmers), bounds, 64)
    assert (keys[0] == keys[1]).all()
    assert (keys[0] == keys[2]).mean() < 0.75  # the same k-mers in another order
    short = order_minhash.sketch_keys(np.array([5, 6, 6], np.uint64), np.array([0, 1, 3]), 3)
    assert short.shape == (2, 3)


def brute_classes(rows, least=0.8):
    """Smallest doc_id of the component of each doc_id."""
    rows = [(i, t) for i, t in rows if i is not None]
    hashes, bounds = words.word_hashes(pa.array([t or "" for _, t in rows], pa.string()))
    each = [hashes[a:b] for a, b in zip(bounds, bounds[1:])]
    root = {i: i for i, _ in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    counts = np.array([np.bincount((w % np.uint64(128)).astype(int), minlength=128) for w in each])
    for a in range(len(rows)):
        differ = counts[a + 1 :] - counts[a]
        least_edits = np.maximum(np.maximum(differ, 0).sum(axis=1), np.maximum(-differ, 0).sum(axis=1))
        longest = np.maximum(counts[a + 1 :].sum(axis=1), counts[a].sum())
        for b in np.flatnonzero(least_edits <= (1 - least) * longest) + a + 1:
            if similar(each[a], each[b], least) is not None:
                x, y = find(rows[a][0]), find(rows[b][0])
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def edited(text, seed, share):
    r = random.Random(seed)
    return " ".join("changed" if r.random() < share else w for w in text.split())


def test_awkward_documents(awkward, scratch, nothing):
    rows = order_minhash.near_documents(awkward, scratch())
    got = rows.collect()
    expected = brute_classes(awkward_texts())
    assert {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None} == expected
    assert sum(r["doc_id"] is None for r in got) == sum(i is None for i, _ in awkward_texts())
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)
    kept = order_minhash.keep_one(awkward, rows)
    assert kept.columns == awkward.columns
    ids = sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect())
    assert ids == sorted(-1 if i is None else i for i, _ in awkward_texts() if i is None or expected[i] == i)
    assert order_minhash.near_documents(nothing, scratch()).count() == 0


def test_groups_of_near_copies_and_a_shared_passage(spark, scratch):
    passage, base = prose(7, 60), prose(8, 200)
    rows = [(k, prose(100 + k, 150) + " " + passage) for k in range(80)]
    rows += [(1000 + k, edited(base, k, 0.03)) for k in range(60)]
    rows += [(2000 + 2 * k + n, edited(prose(500 + k, 120), n, 0.08 * n)) for k in range(30) for n in range(2)]
    rows = rows[::-1]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_documents(docs, scratch()).collect()}
    expected = brute_classes(rows)
    wrong = [i for i in expected if got[i] != expected[i]]
    assert len({expected[i] for i in expected if i >= 1000 and i < 2000}) == 1
    assert all(got[i] == i for i in range(80)) and len(wrong) <= 1


def test_query_classes(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op6_order_minhash"](spark, SF).collect()}
    assert got == brute_classes(rows)


# --- passages -------------------------------------------------------------------------------


def brute_signatures(shingles, least):
    hashed = [
        words.mix(shingles + np.uint64((k + 1) * 0xD1B54A32D192ED03 % (1 << 64))) & ~np.uint64((1 << 24) - 1)
        for k in range(compact_windows.HASHES)
    ]
    found = set()
    for i in range(len(shingles)):
        for j in range(i + least, len(shingles) + 1):
            found.add(tuple(i + int(np.argmin(h[i:j])) for h in hashed))
    return found


def test_joint_windows_are_all_signatures():
    r = np.random.default_rng(0)
    docs = [r.integers(0, 2**63, n).astype(np.uint64) for n in (0, 5, 30, 41, 6)]
    bounds = np.cumsum([0] + [len(d) for d in docs])
    text, position, _ = compact_windows.joint_windows(np.concatenate(docs), bounds, 6)
    for k, d in enumerate(docs):
        assert sorted(min(s) for s in brute_signatures(d, 6)) == sorted(position[text == k].tolist())


def repeated_words(rows, least=50):
    """Words of each doc_id in windows of ``least`` words that a smaller doc_id holds."""
    first, need = {}, defaultdict(set)
    for i, t in sorted((i, t or "") for i, t in rows if i is not None):
        ws = t.lower().split()
        for k in range(len(ws) - least + 1):
            window = tuple(ws[k : k + least])
            if first.setdefault(window, i) != i:
                need[i].update(range(k, k + least))
    return need


def covered(rows):
    got = defaultdict(set)
    for r in rows:
        assert r["other_id"] < r["doc_id"] and r["similarity"] >= 0.8
        got[r["doc_id"]].update(range(r["start"], r["end"]))
    return got


def test_planted_passages(spark, scratch):
    passage, longer = prose(1, 52), prose(2, 300)
    rows = [(k, prose(10 + k, 90) + "\n" + passage + "\n" + prose(900 + k, k % 50)) for k in range(0, 200, 2)]
    rows += [(k, prose(2000 + k, 120)) for k in range(1, 200, 2)]
    rows += [(500, prose(3, 70) + " " + longer), (501, longer + " " + prose(4, 70)), (502, edited(longer, 5, 0.02))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = compact_windows.repeats(docs, scratch())
    got, need = covered(found.collect()), repeated_words(rows)
    assert all(set(range(90, 142)) <= got[k] for k in range(2, 200, 2))
    # by chance a word more agrees with a holder that isn't the smallest
    assert all(len(need[i] - got[i]) <= 2 for i in need)
    assert set(got) == set(need) and len(got[502]) > 240
    dropped = {r["doc_id"]: r["text"] for r in compact_windows.drop_repeats(docs, found).collect()}
    assert passage in dropped[0] and not any(passage in dropped[k] for k in range(2, 200, 2))
    assert all(dropped[k] == dict(rows)[k] for k in range(1, 200, 2))
    assert prose(4, 70) in dropped[501] and dropped[500] == dict(rows)[500]


def test_awkward_passages(awkward, scratch, nothing):
    found = compact_windows.repeats(awkward, scratch())
    got = covered(found.collect())
    assert set(got) == {9} and got[9] == set(range(16_000))
    left = compact_windows.drop_repeats(awkward, found)
    assert left.columns == awkward.columns and left.count() == awkward.count()
    assert {r["text"] for r in left.filter("doc_id = 9").collect()} == {""}
    assert compact_windows.repeats(nothing, scratch()).count() == 0


def test_query_passages(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got, need = covered(QUERIES["op10_compact_windows"](spark, SF).collect()), repeated_words(rows)
    assert set(need) <= set(got)
    assert sum(len(need[i] - got[i]) for i in need) <= 0.01 * sum(map(len, need.values()))
