"""How far the sources of a language diverge from each other, and in which terms a source departs from its language.

A term's price in a group is ``p = 1 + floor(SCALE * (count + 1) / (N + V))``: ``N`` is the sum of the group's counts of
kept terms, ``V`` the number of kept terms of the language. ``diverge(p, q) = floor((p - q) ** 2 / q)``.

The method is a K-squared quadtree over each language's matrix of groups (rows) and kept terms (columns). Groups are
ordered by falling totals, terms are dealt to stripes and ordered so within them: counts gather in few quadrants.

* Quadrants without a count are uniform: all of a group's prices in them are its price ``p0`` of an absent term. They
  are never stored or visited. With ``J`` the terms that both groups of a pair have, the divergence is::

    sum over g's terms of f(p, q0)  +  sum over h's terms of f(p0, q)  +  (V - |g| - |h|) * f(p0, q0)
      +  sum over J of  f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

  The first line prices whatever lies in a quadrant that is empty for one or both groups, from each group's number of
  terms at each price alone (``marginals``).
* The second line needs the leaves that are nonzero for both. The tree's upper levels are keys: a *tile* is ``SIDE``
  groups by a stripe of some ``STRIPE`` terms, and two tiles meet only where both have counts. Below, a task walks both
  trees together, ``K`` by ``K`` children at a time, and goes on only where both quadrants are nonzero (``joint``).

Texts are read once and counted in the task (at most ``HELD`` counts are held before they are passed on): a task passes
on one row a term with its sources, so a hot source or term is few rows. Everything is whole numbers. Terms are
told apart by a hash that is checked to be different for all of them.

Defined cases: null text, language or source read as ''; a group without terms still has its pairs (``V`` = 0: all
values 0); repeated rows count as often as they stand there; ids and other columns are not read; a long text is counted
whole; an empty table gives no rows. Ties of a rank go by the item's UTF-8.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendguard.llm.curriculum import numbered
from spendguard.runtime import checkpointed

SCALE = 1_000_000_000
LEAST_DOCS = 3
TOP_TERMS = 200
K = 4
SIDE = 64  # K ** 3
STRIPE = 1024
HELD = 1_000_000
#: A table of more rows than this is joined by shuffling.
BOUND = 100_000

#: Bytes of terms (letters in lower case, all of UTF-8 outside ASCII) stay, all others separate.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

PACKED = "lang string, term string, docs long, sources array<string>, counts array<long>"


def _packed(lang: str, counts: dict[str, Counter], docs: Counter) -> pa.RecordBatch:
    """One row for each term of a language: how many texts have it, the sources and the counts there."""
    terms = [*docs]
    number = dict(zip(terms, range(len(terms)), strict=True))
    of = np.concatenate([np.fromiter(map(number.__getitem__, c), np.int64, len(c)) for c in counts.values()])
    n = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in counts.values()])
    source = np.repeat(np.arange(len(counts)), [len(c) for c in counts.values()])
    order = np.argsort(of, kind="stable")
    ends = pa.array(np.searchsorted(of[order], np.arange(len(terms) + 1)), pa.int32())
    columns = [
        pa.array([lang] * len(terms), pa.string()),
        pa.array([t.decode("utf-8", "replace") for t in terms], pa.string()),
        pa.array(np.fromiter(docs.values(), np.int64, len(docs))),
        pa.ListArray.from_arrays(ends, pa.array([*counts], pa.string()).take(pa.array(source[order]))),
        pa.ListArray.from_arrays(ends, pa.array(n[order])),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "term", "docs", "sources", "counts"])


def term_counts(docs: DataFrame, most_held: int = HELD) -> DataFrame:
    """``(lang, term, source, n, docs)``: occurrences of each term in each group that has it, and how many documents
    of the language have it, given on one of the term's rows and 0 on the others."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
        within: dict[str, Counter] = defaultdict(Counter)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, of in counts.items():
                batch = _packed(lang, of, within[lang])
                for at in range(0, batch.num_rows, 20_000):
                    yield batch.slice(at, 20_000)
            counts.clear()
            within.clear()

        for batch in batches:
            for text, lang, source in zip(*[batch.column(c).to_pylist() for c in ("text", "lang", "source")], strict=True):
                words = text.encode("utf-8", "surrogatepass").translate(_TERM).split()
                counts[lang][source].update(words)
                within[lang].update(set(words))
            if sum(len(c) for of in counts.values() for c in of.values()) > most_held:
                yield from rows()
        yield from rows()

    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    packed = read.mapInArrow(count, PACKED).repartition("lang", "term")
    # All rows of a term are together now, and stay so.
    first = F.when(F.col("_at") == 0, F.col("docs")).otherwise(F.lit(0))
    each = packed.select("lang", "term", "docs", F.posexplode(F.arrays_zip("sources", "counts")).alias("_at", "_each"))
    each = each.select("lang", "term", F.col("_each.sources").alias("source"), F.col("_each.counts").alias("n"), first.alias("docs"))
    return each.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BOUND else df


def price(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + 1) / (total + terms))``, exact for all longs; null without terms."""
    above = (n.cast("decimal(20,0)") + 1) * F.lit(SCALE).cast("decimal(11,0)")
    below = total.cast("decimal(20,0)") + terms.cast("decimal(20,0)")
    return F.when(terms > 0, F.lit(1) + F.call_function("div", above, below).cast("long"))


def diverge(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _distinct_hash(terms: DataFrame) -> Column:
    """A hash of ``term`` that no two of the ``(lang, term)`` share within a language."""
    for seed in range(100):
        col = F.xxhash64(F.lit(seed), F.col("term"))
        if terms.groupBy("lang", col.alias("col")).count().where("count > 1").isEmpty():
            return col
    raise RuntimeError("no hash tells these terms apart")


class Matrix:
    """Group-term counts of all languages: ``groups`` and ``cells`` (the nonzero counts of kept terms)."""

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS, width: int = STRIPE):
        term = Window.partitionBy("lang", "term")
        summed = term_counts(docs).select("*", F.sum("docs").over(term).alias("_docs"), F.sum("n").over(term).alias("all"))
        kept = checkpointed(summed.where(F.col("_docs") >= least_docs).select("lang", "term", "source", "n", "all"))
        own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("size"))
        terms = checkpointed(kept.select("lang", "term").distinct())
        sums = kept.groupBy("lang").agg(F.sum("n").alias("all_n"))
        sums = sums.join(terms.groupBy("lang").agg(F.count("*").alias("v")), "lang")
        names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
        groups = docs.select(*names).distinct().join(own, ["lang", "source"], "left").join(sums, "lang", "left")
        groups = groups.na.fill(0, ["total", "size", "v", "all_n"])
        groups = checkpointed(numbered(groups, "row", F.col("lang"), F.desc("total"), F.col("source")))
        first = groups.groupBy("lang").agg(F.min("row").alias("_first"))
        groups = groups.join(first, "lang").withColumn("row", F.col("row") - F.col("_first")).drop("_first")
        self.groups = checkpointed(groups.withColumn("p0", price(F.lit(0), F.col("total"), F.col("v"))))
        rows = _few(self.groups.select("lang", "source", "row", "total", "p0", "v", "all_n"))
        col = _distinct_hash(terms)
        stripe = F.pmod(col, F.ceil(F.col("v") / width))
        self.cells = kept.join(rows, ["lang", "source"]).select(
            "lang", "source", "row", "term", col.alias("col"), stripe.alias("stripe"), "p0",
            price(F.col("n"), F.col("total"), F.col("v")).alias("p"),
            price(F.col("all"), F.col("all_n"), F.col("v")).alias("q"),
        )


def marginals(matrix: Matrix) -> DataFrame:
    """``(lang, g, h, value)`` of ordered pairs of rows: all but the leaves that both have, as said above."""
    bins = matrix.cells.groupBy("lang", "row", "p").agg(F.count("*").alias("n"))
    sides = matrix.groups.select("lang", F.col("row").alias("other"), F.col("p0").alias("other_p0"))
    priced = bins.join(_few(sides), "lang").where("row <> other")
    as_g = priced.select("lang", F.col("row").alias("g"), F.col("other").alias("h"),
                         (F.col("n") * diverge(F.col("p"), F.col("other_p0"))).alias("value"))
    as_h = priced.select("lang", F.col("other").alias("g"), F.col("row").alias("h"),
                         (F.col("n") * diverge(F.col("other_p0"), F.col("p"))).alias("value"))
    own = matrix.groups.select("lang", F.col("row").alias("g"), F.col("p0").alias("gp"), F.col("size").alias("gs"), "v")
    far = matrix.groups.select("lang", F.col("row").alias("h"), F.col("p0").alias("hp"), F.col("size").alias("hs"))
    blank = (F.col("v") - F.col("gs") - F.col("hs")) * diverge(F.col("gp"), F.col("hp"))
    rest = own.join(_few(far), "lang").where("g <> h").select("lang", "g", "h", F.coalesce(blank, F.lit(0)).alias("value"))
    return as_g.unionByName(as_h).unionByName(rest).groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


def quadrants(present: np.ndarray) -> list[np.ndarray]:
    """Levels of a K-squared tree over a square matrix of flags, from the root's children to the cells: each is shaped
    ``(parent row, child row, parent column, child column)``."""
    levels, side = [], len(present)
    while side > 1:
        levels.append(present.reshape(side // K, K, side // K, K))
        present = levels[-1].any(axis=(1, 3))
        side //= K
    return levels[::-1]


def shared_leaves(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(g, h, t)`` of all cells that are nonzero in row g of ``left`` and row h of ``right``, by walking both trees."""
    g = h = t = np.zeros(1, np.int64)
    for a, b in zip(quadrants(left), quadrants(right), strict=True):
        both = a[g, :, t, :][:, :, None, :] & b[h, :, t, :][:, None, :, :]
        at, i, j, k = np.nonzero(both)
        g, h, t = g[at] * K + i, h[at] * K + j, t[at] * K + k
    return g, h, t


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _tile(row: np.ndarray, col: np.ndarray, cells: pd.DataFrame, side: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Prices of a tile, 0 where there is no count, as ``(subtree, row, column)``, and the rows' ``p0``."""
    prices = np.zeros((width, side, side), np.int64)
    absent = np.ones(side, np.int64)
    prices[col // side, row, col % side] = cells["p"].to_numpy()
    absent[row] = cells["p0"].to_numpy()
    return prices, absent


def _meet(key: tuple, cells: pd.DataFrame, side: int) -> pd.DataFrame:
    """Sums over the leaves that two tiles share, for each two of their rows and both directions."""
    lang, _, a, b = key
    _, col, often = np.unique(cells["col"].to_numpy(), return_inverse=True, return_counts=True)
    place = np.empty(len(often), np.int64)
    place[np.argsort(-often, kind="stable")] = np.arange(len(often))
    col, block, row = place[col], cells["block"].to_numpy(), (cells["row"] % side).to_numpy()
    subtrees = -(-len(often) // side)
    at_a, at_b = block == a, block == b
    left, left0 = _tile(row[at_a], col[at_a], cells[at_a], side, subtrees)
    right, right0 = _tile(row[at_b], col[at_b], cells[at_b], side, subtrees)
    forth, back = np.zeros((2, side * side), np.int64)
    seen = np.zeros(side * side, bool)
    for x, y in zip(left, right, strict=True):
        g, h, t = shared_leaves(x > 0, y > 0)
        if a == b:
            g, h, t = (v[g < h] for v in (g, h, t))
        p, q, p0, q0 = x[g, t], y[h, t], left0[g], right0[h]
        np.add.at(forth, g * side + h, _f(p, q) - _f(p, q0) - _f(p0, q) + _f(p0, q0))
        np.add.at(back, g * side + h, _f(q, p) - _f(q, p0) - _f(q0, p) + _f(q0, p0))
        seen[g * side + h] = True
    at = np.flatnonzero(seen)
    g, h = a * side + at // side, b * side + at % side
    sums = {"g": [*g, *h], "h": [*h, *g], "value": np.concatenate((forth[at], back[at]))}
    return pd.DataFrame({"lang": lang, **sums})


def joint(matrix: Matrix, side: int = SIDE) -> DataFrame:
    """``(lang, g, h, value)``: what the leaves that both rows of a pair have add to ``marginals``; ``side`` is a power
    of ``K``."""

    def meet(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        return _meet(key, cells, side)

    block = F.floor(F.col("row") / side).alias("block")
    cells = matrix.cells.select("lang", "stripe", block, "row", "col", "p", "p0")
    if matrix.groups.where(F.col("row") >= side).isEmpty():  # all groups of a language are in one tile of a stripe
        met = cells.withColumns({"a": F.col("block"), "b": F.col("block")})
    else:
        tiles = checkpointed(cells.select("lang", "stripe", "block").distinct())
        meets = tiles.withColumnRenamed("block", "other").join(tiles, ["lang", "stripe"])
        met = cells.join(meets, ["lang", "stripe", "block"])
        met = met.withColumns({"a": F.least("block", "other"), "b": F.greatest("block", "other")})
    keyed = met.select("lang", "stripe", "a", "b", "block", "row", "col", "p", "p0")
    sums = keyed.groupBy("lang", "stripe", "a", "b").applyInPandas(meet, "lang string, g long, h long, value long")
    return sums.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, side: int = SIDE, width: int = STRIPE
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: for each group its divergence from each other source of its language
    (part ``pair``, all of them) and the terms it has more of than its language (part ``term``, the first
    ``top_terms``)."""
    matrix = Matrix(docs, least_docs, width)
    value = F.sum("value").alias("value")
    pairs = marginals(matrix).unionByName(joint(matrix, side)).groupBy("lang", "g", "h").agg(value)
    names = matrix.groups.select("lang", "source", "row")
    own = names.select("lang", F.col("row").alias("g"), "source")
    far = names.select("lang", F.col("row").alias("h"), F.col("source").alias("item"))
    pairs = pairs.join(_few(own), ["lang", "g"]).join(_few(far), ["lang", "h"])
    terms = matrix.cells.where("p > q").select("lang", "source", F.col("term").alias("item"),
                                               diverge(F.col("p"), F.col("q")).alias("value"))
    return _ranked(pairs, "pair").unionByName(_ranked(terms, "term", top_terms))
