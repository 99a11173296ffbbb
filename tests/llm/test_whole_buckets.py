"""Large buckets of the order min-hash: every pair is compared or linked through others."""

import random

import numpy as np

from awkward import prose
from ledgerloom.llm import order_minhash, words
from test_near_documents import brute_classes

import pyarrow as pa


def key_of(text):
    """The key in the first table."""
    hashes, _ = words.word_hashes(pa.array([text]))
    kmers = order_minhash.labelled_kmers(hashes)
    return int(order_minhash.sketch_keys(kmers, np.array([0, len(kmers)]), 1)[0, 0])


def altered(text, seed, share):
    r = random.Random(seed)
    return " ".join(f"new{r.randrange(1 << 40)}" if r.random() < share else w for w in text.split())


def in_bucket(text, share, n, start=0):
    """Altered copies that keep the key of the text's first table."""
    out, seed, key = [], start, key_of(text)
    while len(out) < n:
        if key_of(t := altered(text, seed, share)) == key:
            out.append(t)
        seed += 1
    return out


def classes(spark, scratch, rows, parts):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return {r["doc_id"]: r["class_id"] for r in order_minhash.near_documents(docs, scratch(), tables=1).collect()}


def test_copies_that_only_the_base_links(spark, scratch):
    base = prose(71, 200)
    copies = in_bucket(base, 0.13, 30)
    rows = [*enumerate(copies[:20]), (20, base), *enumerate(copies[20:], 21)]
    expected = brute_classes(rows)
    assert len(set(expected.values())) <= 3
    assert classes(spark, scratch, rows, 4) == expected


def test_copies_dont_make_a_bucket_large(spark, scratch):
    text = prose(72, 200)
    u, w = in_bucket(text, 0.27, 2)
    v = in_bucket(u, 0.05, 1)[0]
    rows = [*((k, text) for k in range(40)), (100, u), (101, w), (102, v)]
    expected = brute_classes(rows)
    assert expected[102] == 100 and expected[101] == 101
    assert classes(spark, scratch, rows, 40) == expected
    sketched = order_minhash.sketches(spark.createDataFrame(rows, "doc_id long, text string"), 1)
    members = order_minhash.buckets(order_minhash.distinct_texts(sketched)).collect()
    assert {(r["doc"], r["n"]) for r in members} == {(0, 4), (100, 4), (101, 4), (102, 4)}
