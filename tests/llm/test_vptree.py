import math
import random

import numpy as np
from pyspark.sql import functions as F

from spendguard.llm import vptree


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS v", "2 AS shard", "'x' AS tree")


def plain(rows, k=10):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in good:
        if q % 5 == 0:
            near = sorted((math.sqrt(((y - x) ** 2).sum()), i) for i, y in good if i != q and len(y) == len(x))
            out[q] = near[:k]
    return out


def rows_of(rng, n, spread):
    return [(i, [rng.gauss(0, 1) + spread * (i % 7) for _ in range(6)]) for i in range(n)]


def test_exact_at_factor_one(spark):
    rng = random.Random(3)
    rows = rows_of(rng, 700, 3) + [(1000 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for i in range(300)]
    rows += [(2000, None), (2005, [0.0] * 6), (2010, [1.0, float("nan")] * 3), (2015, [1.0, None]), (2020, [float("inf")] * 6), (None, [1.0] * 6), (2025, []), (2030, [1.0, 2.0]), (2031, [2.0, 2.0])]
    expected = plain(rows)
    for size, block in ((10_000, 10_000), (150, 40), (40, 7)):
        got = {}
        found = vptree.nearest(table(spark, rows), F.col("vec_id") % 5 == 0, factor=1.0, shard_rows=size, block_rows=block)
        for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
            got.setdefault(r.query_id, []).append((r.score, r.vec_id))
            assert len(got[r.query_id]) == r["rank"]
        assert got.keys() == {q for q, near in expected.items() if near}
        for q, near in got.items():
            assert [i for _, i in near] == [i for _, i in expected[q]], q
            assert np.allclose([s for s, _ in near], [s for s, _ in expected[q]], rtol=1e-12)


def test_recall_when_pruning_is_relaxed():
    rng = np.random.default_rng(4)
    points = rng.normal(size=(3000, 8)) + 4 * rng.integers(0, 5, size=(3000, 1))
    tree = vptree.build(points)
    queries = points[:100]
    exact = [set(np.argsort(vptree.distances(points, q), kind="stable")[:10]) for q in queries]
    _, one = vptree.search(tree, points, queries, 10, 1.0)
    _, relaxed = vptree.search(tree, points, queries, 10, 1.5)
    assert all(set(o) == e for o, e in zip(one, exact, strict=True))
    assert np.mean([len(set(o) & e) / 10 for o, e in zip(relaxed, exact, strict=True)]) >= 0.9


def test_few_or_no_candidates(spark):
    one = table(spark, [(0, [1.0, 2.0])])
    assert vptree.nearest(one, F.col("vec_id") % 5 == 0).count() == 0
    assert vptree.nearest(one.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    two = table(spark, [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (0, [1.0, 2.0])])
    assert {(r.query_id, r.vec_id, r.score) for r in vptree.nearest(two, F.col("vec_id") % 5 == 0).collect()} == {(0, 1, 0.0)}


def test_rows_that_repeat_an_id(spark):
    rows = [(0, [1.0, 2.0])] * 30 + [(1, [1.0, 2.0])] * 2 + [(5, [1.0, 2.5]), (7, [4.0, 4.0])]
    got = {}
    for r in vptree.nearest(table(spark, rows), F.col("vec_id") % 5 == 0, k=3, shard_rows=4).collect():
        got.setdefault(r.query_id, set()).add((r["rank"], r.vec_id, r.score))
    assert got == {0: {(1, 1, 0.0), (2, 1, 0.0), (3, 5, 0.5)}, 5: {(1, 0, 0.5), (2, 0, 0.5), (3, 0, 0.5)}}


def test_far_leaves_are_left_out_and_near_ones_are_not():
    rng = np.random.default_rng(8)
    points = rng.normal(size=(4000, 5)) + 40 * rng.integers(0, 4, size=(4000, 1))
    top = vptree.Top(points[:500], 16)
    leaf, away = top.home(points)
    assert len(top.centre) == 16 and set(leaf) == set(range(16))
    radius = {i: away[leaf == i].max() for i in range(16)}
    bound = np.array([np.sort(vptree.distances(points, p))[10] for p in points[:200]])
    query, on = top.within(points[:200], bound, radius, 1.0)
    left = {(int(a), int(b)) for a, b in zip(query, on, strict=True)}
    for i, p in enumerate(points[:200]):
        assert {(i, int(x)) for x in leaf[vptree.distances(points, p) <= bound[i]]} <= left
    assert len(left) < 200 * 8
    none, _ = top.within(points[:200], bound, {}, 1.0)
    assert not len(none)
