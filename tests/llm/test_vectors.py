"""Near-duplicate vectors and nearest neighbours against brute force."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from awkward import SF
from ledgerloom.llm import cap_filters, dimension_scan
from ledgerloom.llm.components import components
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.stage import table
from ledgerloom.llm.vectors import rotation

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, filters string, `list` string"


def brute_classes(rows, least):
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    valid = [
        e is not None and all(c is not None and np.isfinite(c) for c in e) and any(e) and y is not None and i is not None
        for i, e, y in rows
    ]
    unit = [np.array(e, float) / np.linalg.norm(np.array(e, float)) if v else None for (_, e, _), v in zip(rows, valid)]
    for a in range(n):
        for b in range(n):
            if a != b and valid[a] and valid[b] and rows[a][2] == rows[b][2] and unit[a] @ unit[b] >= least - 1e-12:
                links[a] += 1
                x, y = find(a), find(b)
                root[x] = y
    smallest = defaultdict(list)
    for a in range(n):
        if rows[a][0] is not None:
            smallest[find(a)].append(rows[a][0])
    return sorted((str(i), k, str(min(smallest[find(a)], default=None))) for a, ((i, _, _), k) in enumerate(zip(rows, links)))


def vectors(seed=1, n=300, size=16):
    r = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        x = r.standard_normal(size)
        rows.append((k, x.astype(np.float32).tolist(), k % 3))
        if k % 4 == 0:  # a near copy, a scaled copy, an exact copy
            rows.append((1000 + k, (x + 0.04 * r.standard_normal(size)).astype(np.float32).tolist(), k % 3))
            rows.append((2000 + k, (x.astype(np.float32) * 2).tolist(), k % 3))
            rows.append((3000 + k, x.astype(np.float32).tolist(), (k + (k % 8 == 0)) % 3))
    centre = r.standard_normal(size)
    rows += [(5000 + k, (centre + 0.02 * r.standard_normal(size)).astype(np.float32).tolist(), 1) for k in range(60)]
    nan = [float("nan")] + [1.0] * (size - 1)
    odd = [(9000, None, 1), (9001, [0.0] * size, 1), (9002, nan, 1), (9003, [None] + [1.0] * (size - 1), 1)]
    odd += [(9004, rows[0][1], None), (None, rows[0][1], 0), (9005, [float("inf")] * size, 0), (7, rows[7][1], rows[7][2])]
    return rows + odd


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(*r, "r", "f", "l") for r in vectors()], SCHEMA).repartition(4)


def test_near_vectors(frame, scratch):
    got = cap_filters.near_vectors(frame, scratch(), block=16)
    rows = got.collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in rows) == brute_classes(vectors(), 0.98)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)


def test_no_vectors(spark, scratch, frame):
    none = frame.filter("false")
    assert cap_filters.near_vectors(none, scratch()).count() == 0
    assert dimension_scan.nearest(none, scratch(), F.col("vec_id") % 2 == 0).count() == 0
    unlike = spark.createDataFrame([(1, [1.0], 0), (2, [1.0, 2.0], 0)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(ValueError, match="components"):
        cap_filters.near_vectors(unlike, scratch())


def test_cap_filters_keep_near_pairs():
    r = np.random.default_rng(2)
    a = r.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    g = r.standard_normal(a.shape)
    g -= (g * a).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * g / np.linalg.norm(g, axis=1, keepdims=True)
    turn, words = rotation(64, cap_filters.SEED), cap_filters.codewords(64, 256)

    def decoded(x):
        x = x @ turn
        return [set(cap_filters.list_decode(p, q, 16).tolist()) for p, q in zip(x[:, :32] @ words[0].T, x[:, 32:] @ words[1].T)]

    missed = sum(not (p & q) for p, q in zip(decoded(a), decoded(b)))
    assert missed <= 2


def test_query_near_vectors(spark):
    rows = [tuple(r) for r in table(spark, SF, "embeddings").select("vec_id", "embedding", "label").collect()]
    got = QUERIES["op3_cap_filters"](spark, SF).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in got) == brute_classes(rows, 0.98)


def brute_nearest(rows, queries, k):
    ids = {}
    for i, e, *_ in rows:
        if i is not None and e is not None and all(c is not None and np.isfinite(c) for c in e) and any(e):
            ids.setdefault(i, []).append(np.array(e, float))
    out = {}
    for q in queries:
        if q not in ids:
            continue
        for x in ids[q][:1]:
            scores = [(-max(float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y))) for y in ys), i) for i, ys in ids.items() if i != q]
            out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in scores)[:k]]
    return out


def test_nearest_with_all_lists_probed_is_exact(frame, scratch):
    asked = F.col("vec_id") % 50 == 0
    got = dimension_scan.nearest(frame, scratch(), asked, lists=4, probes=4, block=64, query_block=8).collect()
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    rows = vectors()
    expected = brute_nearest(rows, {r[0] for r in rows if r[0] is not None and r[0] % 50 == 0}, 5)
    assert set(found) == set(expected)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= 0.97 * 5 * len(expected)
    assert all([s for _, s in found[q]] == sorted((s for _, s in found[q]), reverse=True) for q in found)


def test_few_candidates_and_ties(spark, scratch):
    rows = [(50, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [2.0, 0.0]), (1, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = dimension_scan.nearest(frame, scratch(), F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(50, 1, 2, 1.0), (50, 2, 3, 1.0), (50, 3, 1, 0.0)]


def test_recall_of_the_query(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.1", "embeddings").select("vec_id", "embedding").collect()]
    got = defaultdict(set)
    for r in QUERIES["op8_dimension_scan"](spark, "/root/testdata/sf0.1").collect():
        got[r["query_id"]].add(r["vec_id"])
    expected = brute_nearest(rows, {r[0] for r in rows if r[0] % 50 == 0}, 5)
    hits = sum(len(got[q] & {i for i, _ in e}) for q, e in expected.items())
    assert hits >= 0.9 * sum(len(e) for e in expected.values())


def test_components(spark, scratch):
    r = np.random.default_rng(0)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [tuple(map(int, r.integers(200, 300, 2))) for _ in range(60)] + [(7, 7)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long"), scratch()).collect()}
    root = {k: k for e in edges for k in e}
    for _ in range(len(edges)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    linked = {k for a, b in edges if a != b for k in (a, b)}
    assert got == {k: v for k, v in root.items() if k in linked}


def test_doubles_of_extreme_size(spark, scratch):
    """Components whose squares overflow or vanish: all pairs here have cosines above 0.99."""
    rows = [(0, [1e200, 0.0], 1), (1, [1e200, 1e198], 1), (2, [1e-200, 1e-202], 1), (3, [1.0, 0.0], 1), (50, [5e-310, 0.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    classes = cap_filters.near_vectors(frame, scratch()).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in classes} == {(i, 4, 0) for i, _, _ in rows}
    near = dimension_scan.nearest(frame, scratch(), F.col("vec_id") % 50 == 0).collect()
    assert len(near) == 8 and all(0.99 < r["score"] <= 1 + 1e-12 for r in near)
