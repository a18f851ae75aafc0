"""Nearest neighbours by vantage-point trees, one for each shard of the vectors.

Shards are regions of space: a top tree of at most ``TOP_LEAVES`` leaves, fitted on ``SAMPLE`` rows at most (picked by a
hash), sends every row down to one leaf. A leaf of more than ``shard_rows`` rows is dealt into several shards. Each
shard becomes a tree, a row with a few arrays, written once. A query first meets the trees of its own leaf; the k-th
distance found there bounds the rest: a leaf is left out if ``factor`` times the gap to its side of a split, or to the
ball around its centre that holds all its rows, exceeds that bound. Queries go in blocks to the leaves that remain, the
blocks of a busy leaf to several copies of its trees. Neither trees nor queries are gathered anywhere.

A node of a tree has a vantage point; the points below it are sorted by their distance from it and halved, and each
half keeps the smallest and largest of these distances. By the triangle inequality a half cannot hold a point nearer
than the gap between the query's distance and that range. A half is skipped if ``factor`` times the gap exceeds the
distance of the k-th nearest so far. With factor 1 the search is exact; a larger one skips more.

Equal vectors lie in one leaf and are one point of its tree, with their ``2 k`` smallest ids: no query can use more
of them (some may be its own). Where a vector repeats more often, the others are left out of the index before rows are
shuffled, so a vector that a third of all rows share does no harm and no answer changes.

Defined cases: vectors that are null, zero, of no elements or with null or non-finite components take no part, neither
do rows without an id; with fewer than k candidates all are returned; ties go to the smaller id. Vectors of another
length than the query's are not its candidates. Rows that repeat an id count as one row each, except that a query
never finds its own id. Extra columns are not read.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendguard.runtime import checkpointed

SHARD_ROWS = 16_384
BLOCK_ROWS = 1024
LEAF = 64
FACTOR = 1.0
SAMPLE = 16_384
TOP_LEAVES = 1024
COPIES = 8


def usable(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` of the rows that take part."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("v", lambda x: x != 0)
    return vectors.select(F.col(id_).cast("long").alias("vec_id"), F.col(vector).alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(some, F.lit(False))
    )


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Euclidean distances, in double precision, of the difference itself."""
    d = points - to
    return np.sqrt(np.einsum("...i,...i->...", d, d))


def build(points: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """A tree over distinct points.

    ``order`` lists the points as they lie in the leaves. Node i covers ``order[first[i]:last[i]]``; its vantage point
    is the first of them. ``left`` and ``right`` are its halves, or -1; ``low`` and ``high`` are the distance ranges of
    a node's points from its parent's vantage point.
    """
    order = np.arange(len(points))
    nodes: list[list[float]] = []

    def add(a: int, b: int, low: float, high: float) -> int:
        nodes.append([a, b, -1, -1, low, high])
        return len(nodes) - 1

    todo = [add(0, len(points), 0.0, np.inf)] if len(points) else []
    while todo:
        i = todo.pop()
        a, b = int(nodes[i][0]), int(nodes[i][1])
        if b - a <= leaf:
            continue
        # The point farthest from the middle one separates best.
        far = a + int(np.argmax(distances(points[order[a:b]], points[order[(a + b) // 2]])))
        order[a], order[far] = order[far], order[a]
        d = distances(points[order[a + 1 : b]], points[order[a]])
        by = np.argsort(d, kind="stable")
        order[a + 1 : b], d = order[a + 1 : b][by], d[by]
        half = len(d) // 2
        nodes[i][2] = add(a + 1, a + 1 + half, d[0], d[half - 1])
        nodes[i][3] = add(a + 1 + half, b, d[half], d[-1])
        todo += [int(nodes[i][2]), int(nodes[i][3])]
    table = np.array(nodes, float).reshape(-1, 6)
    whole = {n: table[:, k].astype(np.int64) for k, n in enumerate(("first", "last", "left", "right"))}
    return {"order": order, **whole, "low": table[:, 4], "high": table[:, 5]}


class Top:
    """The top tree over vectors of one length. Node i splits at distance ``mu[i]`` from ``vantage[i]``; its sides are
    ``near[i]`` and ``far[i]``, nodes or, as -1 - leaf, leaves. A leaf has a centre, of no meaning but for its ball."""

    def __init__(self, points: np.ndarray, leaves: int):
        self.vantage, self.mu, self.near, self.far, self.centre = [], [], [], [], []
        self.root = self._grow(np.unique(points, axis=0), leaves)

    def _grow(self, points: np.ndarray, leaves: int) -> int:
        middle = points[np.argmin(distances(points, points.mean(axis=0)))]
        if leaves > 1 and len(points) > 1:
            vantage = points[np.argmax(distances(points, middle))]
            d = np.sort(distances(points, vantage))
            mu = d[max(0, len(d) * (leaves // 2) // leaves - 1)]
            inner = distances(points, vantage) <= mu
            if not inner.all():
                i = len(self.mu)
                self.vantage.append(vantage), self.mu.append(mu), self.near.append(0), self.far.append(0)
                self.near[i] = self._grow(points[inner], leaves // 2)
                self.far[i] = self._grow(points[~inner], leaves - leaves // 2)
                return i
        self.centre.append(middle)
        return -len(self.centre)

    def home(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leaf of each point, and the distance from its centre."""
        leaf, away = np.zeros(len(points), np.int64), np.zeros(len(points))
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            i, q = todo.pop()
            if i < 0:
                leaf[q], away[q] = -1 - i, distances(points[q], self.centre[-1 - i])
                continue
            inner = distances(points[q], self.vantage[i]) <= self.mu[i]
            todo += [(c, x) for c, x in ((self.near[i], q[inner]), (self.far[i], q[~inner])) if len(x)]
        return leaf, away

    def within(self, points: np.ndarray, bound: np.ndarray, radius: dict[int, float], factor: float):
        """Numbers of points and of leaves that may hold something within ``bound`` of them."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            i, q = todo.pop()
            if i < 0:
                d = distances(points[q], self.centre[-1 - i])
                q = q[_open(d - radius.get(-1 - i, -np.inf), d, bound[q], factor)]
                out.append((q, np.full(len(q), -1 - i)))
                continue
            d = distances(points[q], self.vantage[i])
            sides = ((self.near[i], d - self.mu[i]), (self.far[i], self.mu[i] - d))
            todo += [(c, x) for c, gap in sides if len(x := q[_open(gap, d, bound[q], factor)])]
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _open(gap: np.ndarray, d: np.ndarray, bound: np.ndarray, factor: float) -> np.ndarray:
    """Whether a region at a gap is within the bound, with room for rounding."""
    with np.errstate(invalid="ignore"):
        return (gap < np.inf) & (np.maximum(gap, 0) * factor <= bound * (1 + 1e-9) + 1e-12 * d)


def search(
    tree: dict[str, np.ndarray],
    points: np.ndarray,
    queries: np.ndarray,
    k: int,
    factor: float = FACTOR,
    bound: np.ndarray | None = None,
):
    """Distances and numbers of the ``k`` nearest points of each query, nearest first, ties to the smaller number;
    missing ones are inf and -1. Points beyond ``bound`` may be missing.

    A first descent to each query's own leaf gives a bound; a second one, of all queries at once, visits what the
    bound leaves over. Points at the bound itself are visited, as ties may go to them.
    """
    n = len(queries)
    best = np.full((n, k), np.inf)
    which = np.full((n, k), -1)
    if not len(points):
        return best, which
    bound = np.full(n, np.inf) if bound is None else bound
    order, first, last, left, right = (tree[x] for x in ("order", "first", "last", "left", "right"))
    low, high = tree["low"], tree["high"]

    def offer(q: np.ndarray, at: np.ndarray) -> None:
        d = np.concatenate([best[q], distances(points[at][None, :, :], queries[q][:, None, :])], axis=1)
        p = np.concatenate([which[q], np.broadcast_to(at, (len(q), len(at)))], axis=1)
        keep = np.lexsort((p, d), axis=1)[:, :k]
        best[q], which[q] = np.take_along_axis(d, keep, 1), np.take_along_axis(p, keep, 1)

    home = np.zeros(n, np.int64)
    todo = [(0, np.arange(n))]
    while todo:
        i, q = todo.pop()
        if left[i] < 0:
            home[q] = i
            for part in np.array_split(q, max(1, len(q) // 64)):
                offer(part, order[first[i] : last[i]])
            continue
        d = distances(queries[q], points[order[first[i]]])
        inner = d <= high[left[i]]
        todo += [(int(c), x) for c, x in ((left[i], q[inner]), (right[i], q[~inner])) if len(x)]

    todo = [(0, np.arange(n))]
    while todo:
        i, q = todo.pop()
        if left[i] < 0:
            q = q[home[q] != i]
            for part in np.array_split(q, max(1, len(q) // 64)):
                if len(part):
                    offer(part, order[first[i] : last[i]])
            continue
        at = order[first[i]]
        offer(q, np.array([at]))
        d = distances(queries[q], points[at])
        for c in (left[i], right[i]):
            gap = np.maximum(np.maximum(low[c] - d, d - high[c]), 0)
            on = q[_open(gap, d, np.minimum(best[q, -1], bound[q]), factor)]
            if len(on):
                todo.append((int(c), on))
    return best, which


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.float64)


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _planted(k: int):
    """A group of vectors becomes one tree."""

    def grow(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["vec_id", "qrow"])
        points, ids = _matrix(group.v), group.vec_id.to_numpy(np.int64)
        # Rows are in order of id: points are numbered by their smallest id, and ids of a point ascend.
        _, at, point = np.unique(points, axis=0, return_index=True, return_inverse=True)
        rank = np.argsort(np.argsort(at))
        point, points = rank[point.reshape(-1)], points[np.sort(at)]
        by = np.argsort(point, kind="stable")
        blob = _packed(points=points, ids=ids[by], point=point[by], **build(points))
        return pd.DataFrame([(*key, blob)], columns=["dim", "leaf", "part", "tree"])

    return grow


def _bundled(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    q = _packed(q=_matrix(group.v), qrow=group.qrow, qid=group.vec_id, bound=group.bound)
    return pd.DataFrame([(*key, q)], columns=["dim", "leaf", "block", "queries"])


def _searcher(k: int, factor: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tree, queries in zip(batch.tree, batch.queries, strict=True):
                t, q = np.load(io.BytesIO(tree)), np.load(io.BytesIO(queries))
                t = {n: t[n] for n in t.files}
                # One more than k, as a query's own point may hold no other id.
                d, p = search(t, t["points"], q["q"], k + 1, factor, q["bound"])
                yield _nearest(d, p, t["point"], t["ids"], q["qrow"], q["qid"], k)

    return run


def _nearest(d, p, point, ids, qrow, qid, k: int) -> pd.DataFrame:
    """The found points with all their ids but the query's own; the k first of each query."""
    row, column = np.nonzero(p >= 0)
    found = p[row, column]
    a, b = np.searchsorted(point, found, "left"), np.searchsorted(point, found, "right")
    many = np.repeat(np.arange(len(found)), b - a)
    id_ = ids[np.arange(len(many)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[many]]
    out = pd.DataFrame({"qrow": qrow[row][many], "query_id": qid[row][many], "vec_id": id_, "score": d[row, column][many]})
    out = out[out.vec_id != out.query_id].sort_values(["qrow", "score", "vec_id"])
    return out[out.groupby("qrow").cumcount() < k]


def _first(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query, with their ranks."""
    rank = F.row_number().over(Window.partitionBy("qrow").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def fitted(rows: DataFrame, shard_rows: int, sample: int = SAMPLE, top_leaves: int = TOP_LEAVES) -> dict[int, Top]:
    """Top trees by length of the vectors, from a sample of ``sample`` rows at most."""
    leaves = min(top_leaves, -(-rows.count() // shard_rows))
    picked = rows.orderBy(F.xxhash64("qrow"), "qrow").limit(sample).select("v").toPandas().v if leaves > 1 else pd.Series([])
    length = picked.map(len)
    return {int(n): Top(_matrix(p), -(-leaves * len(p) // len(picked))) for n, p in picked.groupby(length)}


def _placer(top: dict[int, Top]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n, group in batch.groupby(batch.v.map(len)):
                leaf, away = top[n].home(_matrix(group.v)) if n in top else (0, 0.0)
                yield group.assign(dim=n, leaf=leaf, away=away)[["qrow", "vec_id", "v", "dim", "leaf", "away"]]

    return run


def _spreader(top: dict[int, Top], radius: dict[int, dict[int, float]], factor: float):
    """Each query once for each leaf but its own that its bound leaves over."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n, group in batch.groupby("dim"):
                if n in top:
                    q, leaf = top[n].within(_matrix(group.v), group.bound.to_numpy(), radius[n], factor)
                    out = group.iloc[q]
                    yield out.assign(leaf=leaf)[leaf != out.leaf.to_numpy()]

    return run


def _without_surplus(rows: DataFrame, k: int) -> DataFrame:
    """The rows that some query can find, of a vector that repeats: ``k`` of an id and ``2 k`` in all. Rows are only
    moved for that if a vector repeats so often."""
    often = rows.groupBy(F.xxhash64("v")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    if (often or 0) <= 2 * k:
        return rows
    one = Window.partitionBy("v", "vec_id").orderBy("qrow")
    few = rows.withColumn("_place", F.row_number().over(one)).where(F.col("_place") <= k)
    # k rows at most are the query's own, so 2 k are enough.
    many = Window.partitionBy("v").orderBy("vec_id", "qrow")
    return few.withColumn("_place", F.row_number().over(many)).where(F.col("_place") <= 2 * k).drop("_place")


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    factor: float = FACTOR,
    id_: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest of each row for which ``queries`` (of vec_id) holds."""
    rows = checkpointed(usable(vectors, id_, vector).withColumn("qrow", F.monotonically_increasing_id()))
    top = fitted(rows, shard_rows)
    row = f"qrow long, vec_id long, v {rows.schema['v'].dataType.simpleString()}, dim int, leaf int"
    placed = checkpointed(rows.mapInPandas(_placer(top), f"{row}, away double"))
    size = placed.groupBy("dim", "leaf").agg(F.count("*").alias("n"), F.max("away").alias("radius"))
    radius: dict[int, dict[int, float]] = {}
    for r in size.collect():  # a row a leaf
        radius.setdefault(r.dim, {})[r.leaf] = r.radius

    index = _without_surplus(placed, k)
    parts = index.groupBy("dim", "leaf").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("v"), F.col("parts")).cast("int")
    trees = checkpointed(
        index.join(parts, ["dim", "leaf"])
        .withColumn("part", part)
        .select("dim", "leaf", "part", "vec_id", "qrow", "v")
        .groupBy("dim", "leaf", "part")
        .applyInPandas(_planted(k), "dim int, leaf int, part int, tree binary")
    )

    def met(asked: DataFrame) -> DataFrame:
        """What each row of ``asked`` finds in the trees of its leaf."""
        busy = asked.groupBy("dim", "leaf").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
        block = F.pmod(F.xxhash64("qrow"), F.col("blocks")).cast("int")
        blocks = (
            asked.join(busy, ["dim", "leaf"])
            .withColumn("block", block)
            .select("dim", "leaf", "block", "vec_id", "qrow", "v", "bound")
            .groupBy("dim", "leaf", "block")
            .applyInPandas(_bundled, "dim int, leaf int, block int, queries binary")
            .withColumn("copy", F.pmod("block", F.lit(COPIES)))
        )
        copies = F.explode(F.sequence(F.lit(0), F.least(F.col("blocks"), F.lit(COPIES)) - 1))
        there = trees.join(busy, ["dim", "leaf"]).withColumn("copy", copies)
        both = blocks.join(there, ["dim", "leaf", "copy"]).select("tree", "queries")
        return both.mapInPandas(_searcher(k, factor), "qrow long, query_id long, vec_id long, score double")

    asked = placed.where(queries)
    near = checkpointed(_first(met(asked.withColumn("bound", F.lit(float("inf")))), k))
    limit = near.groupBy("qrow").agg(F.when(F.count("*") >= k, F.max("score")).alias("bound"))
    bounded = asked.join(limit, "qrow", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    bounded = bounded.select("qrow", "vec_id", "v", "dim", "leaf", "bound")
    further = checkpointed(bounded.mapInPandas(_spreader(top, radius, factor), f"{row}, bound double"))
    found = near.select("qrow", "query_id", "vec_id", "score").unionByName(met(further))
    return _first(found, k).select("query_id", "rank", "vec_id", "score")
