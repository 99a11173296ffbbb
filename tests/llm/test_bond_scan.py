"""Hard negatives against brute force."""

from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import bond_scan
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.stage import table

SCHEMA = "vec_id long, label int, embedding array<double>, anchor_id string, `a.b` int, slot string"
SF = "/root/testdata/sf0.001"


def brute(rows, asked, positives=5, negatives=10, shares=(30, 90), scale=256):
    valid = [
        (i, y, tuple(int(min(max(np.floor(scale * c), -(2.0**62)), 2.0**62)) for c in e), tuple(e))
        for i, y, e in rows
        if i is not None and y is not None and e is not None and all(c is not None and np.isfinite(c) for c in e)
    ]
    score = lambda a, b: min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1)
    anchors = {}
    for i, y, e, raw in sorted(valid, key=lambda r: (r[1], r[3]), reverse=True):
        if asked(i):
            anchors[i] = (y, e)
    out = []
    for i, (y, e) in anchors.items():
        ranked = sorted((-score(e, f), j, z) for j, z, f, _ in valid if j != i)
        near = [(j, -s) for s, j, z in ranked if z == y][:positives]
        for k, (p, ps) in enumerate(near, 1):
            far = [(j, -s) for s, j, z in ranked if z != y and shares[0] * ps <= -100 * s <= shares[1] * ps][:negatives]
            out += [(i, p, r, j, ps, ns, k) for r, (j, ns) in enumerate(far, 1)]
    return sorted(out)


def vectors(seed=1, n=500, size=12):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((4, size))
    rows = [(k, int(k % 4), (centres[k % 4] * r.random() + r.standard_normal(size)).tolist()) for k in range(n)]
    rows += [(1000 + k, int((k + 1) % 4), rows[k][2]) for k in range(100)]  # ties across labels
    rows += [(2000 + k, 3, rows[7][2]) for k in range(200)]  # a hot group of copies
    odd = [(9000, 1, None), (9010, 1, [0.0] * size), (9020, 1, [float("nan")] * size), (9030, None, rows[0][2]), (None, 1, rows[0][2]),
           (9040, 2, []), (9050, 2, rows[1][2][:5]), (9060, 2, [None, 1.0]), (9070, 0, [float("inf")] * size)]
    return rows + odd + [rows[10], (20, 3, rows[10][2])]


def collected(df):
    return sorted(tuple(r) for r in df.collect())


def test_negatives_equal_brute_force(spark, scratch):
    rows = vectors()
    frame = spark.createDataFrame([(*r, "x", 1, "s") for r in rows], SCHEMA).repartition(5)
    got = collected(bond_scan.hard_negatives(frame, scratch(), F.col("vec_id") % 10 == 0))
    assert got == brute(rows, lambda i: i % 10 == 0) and len({r[0] for r in got}) > 20
    # several chunks of anchors, other shares
    got = collected(bond_scan.hard_negatives(frame, scratch(), F.col("vec_id") % 10 == 0, 2, 3, (0, 100), 8, chunk=200))
    assert got == brute(rows, lambda i: i % 10 == 0, 2, 3, (0, 100), 8)


def test_blocks_shrink_candidates(monkeypatch, spark, scratch):
    """Small blocks, so that floors and bounds of earlier ones decide."""
    monkeypatch.setattr(bond_scan, "BLOCK", 16)
    rows = vectors(2)
    frame = spark.createDataFrame([(*r, "x", 1, "s") for r in rows], SCHEMA).repartition(3)
    assert collected(bond_scan.hard_negatives(frame, scratch(), F.col("vec_id") % 30 == 0)) == brute(rows, lambda i: i % 30 == 0)


def test_extreme_components(spark, scratch):
    r = np.random.default_rng(4)
    rows = [(k, k % 2, (r.standard_normal(3) * 10.0 ** r.integers(-2, 20)).tolist()) for k in range(60)]
    rows += [(100, 0, [1e308, 1.0, 1.0]), (101, 0, [1e308, 0.5, 0.0]), (102, 1, [1e307, 1.0, -1.0]), (103, 1, [3e6, 3e6, 3e6])]
    frame = spark.createDataFrame([(*v, "x", 1, "s") for v in rows], SCHEMA)
    assert collected(bond_scan.hard_negatives(frame, scratch(), F.col("vec_id") % 5 == 0)) == brute(rows, lambda i: i % 5 == 0)


def test_nothing_and_lone_labels(spark, scratch):
    frame = spark.createDataFrame([(1, 0, [1.0], "x", 1, "s"), (2, 1, [1.0], "x", 1, "s")], SCHEMA)
    every = F.lit(True)
    assert bond_scan.hard_negatives(frame.filter("false"), scratch(), every).count() == 0
    assert bond_scan.hard_negatives(frame, scratch(), every).count() == 0
    assert bond_scan.hard_negatives(frame, scratch(), F.col("vec_id") == 5).count() == 0


def test_query_equals_brute_force(spark):
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in table(spark, SF, "embeddings").collect()]
    rows = [(i, (y + 1) % 10 if i % 7 == 0 and y is not None else y, e) for i, y, e in rows]
    grouped = defaultdict(int)
    got = collected(QUERIES["op13_bond_negatives"](spark, SF))
    for r in got:
        grouped[r[:2]] += 1
    assert got == brute(rows, lambda i: i % 100 == 0) and max(grouped.values()) == 10
