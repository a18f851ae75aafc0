"""Benchmark decontamination by greedy string tiling.

A document shares a passage with a test item only where it has ``GRAM`` consecutive words of it, or the whole item if
that is shorter. The documents' word grams are first held against a bit map of all items' grams, of fixed size, which
leaves the runs of words that may be shared; these few are joined with the items' grams. Each gram that a document and
an item share accounts for ``GRAM`` words of the item at most at each of its places, so pairs whose shared grams cannot
add up to the coverage are refused from the counts, before any text meets another. The others are tiled: the longest
match of words that are not yet covered, found by running Karp-Rabin over the runs, is marked, and again, down to the
size of the grams. The share of the item's words under tiles is its coverage. Tiles may lie anywhere and in any order,
so a passage whose sentences were moved about is found as well.

Texts are read once and not shuffled; runs are. A gram that a third of all documents hold is dealt over several tasks.
The items' tables are broadcast while they have at most ``SMALL`` rows and otherwise joined with salted keys. With a
benchmark of millions of grams the map lets more through to the join; answers stay the same.

Defined cases: null texts and texts without words have no grams, and items of them are never found; an item of fewer
than ``GRAM`` words is found where all its words stand together; equal items are all found; repeated documents give
repeated rows; texts of any length are searched whole; empty tables give no rows. Extra columns are not read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendguard.llm import words
from spendguard.llm.common import row_keys, salted, with_salt, without
from spendguard.runtime import checkpointed

GRAM = 5
COVERAGE = 0.5
MAP_BITS = 23
SMALL = 200_000
SALTS = 16

_MULTIPLIER = 0xD6E8FEB86659FD93
_MOD = (1 << 61) - 1


def _grams(doc: np.ndarray, hash_: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``n`` words from each word on, and whether they are of one text."""
    at = len(hash_) - n + 1
    if at <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    total = np.zeros(at, np.uint64)
    for k in range(n):
        total = total * np.uint64(_MULTIPLIER) + hash_[k : k + at]
    return words.mixed(total), doc[:at] == doc[n - 1 :]


def _known_runs(doc: np.ndarray, hash_: np.ndarray, n: int, known: np.ndarray) -> Iterator[tuple]:
    """Text, first word, end and grams of every longest run of grams of ``n`` words that the map has."""
    gram, one = _grams(doc, hash_, n)
    hit = one & known[(gram & np.uint64((1 << MAP_BITS) - 1)).astype(np.int64)]
    # Grams over the end of a text are no hits; grams of one word have none of these, so runs are cut there as well.
    new = np.concatenate(([False], doc[1 : len(gram)] != doc[: max(len(gram) - 1, 0)]))[: len(gram)]
    before = np.concatenate(([False], hit[:-1]))[: len(gram)]
    after = np.concatenate((hit[1:] & ~new[1:], [False]))[: len(gram)]
    firsts, lasts = np.flatnonzero(hit & (~before | new)), np.flatnonzero(hit & ~after)
    for a, b in zip(firsts, lasts + 1, strict=True):
        yield doc[a], a, b + n - 1, gram[a:b]


def item_words(items: DataFrame, id_: str = "item_id", text: str = "text", n: int = GRAM) -> DataFrame:
    """``(item, item_id, size, words, grams)`` of every item with words; ``item`` numbers the rows, ``size`` is that of
    its grams: ``n`` words, or all of a shorter item."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, start, end, hash_, data in words.documents(batch.text.tolist()):
                for d in np.unique(doc):
                    of = doc == d
                    texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(start[of], end[of], strict=True)]
                    size = min(n, len(texts))
                    gram, _ = _grams(doc[of], hash_[of], size)
                    out.append((batch["item"].iloc[d], batch.item_id.iloc[d], size, texts, gram.astype(np.int64)))
            yield pd.DataFrame(out, columns=["item", "item_id", "size", "words", "grams"]).astype({"item_id": "Int64"})

    rows = items.select(
        F.monotonically_increasing_id().alias("item"), F.col(id_).cast("long").alias("item_id"), F.col(text).alias("text")
    )
    return rows.mapInPandas(cut, "item long, item_id long, size int, words array<string>, grams array<long>")


def gram_map(grams: DataFrame) -> np.ndarray:
    """A map of ``2 ** MAP_BITS`` bits, as booleans, of the column ``gram``; at most an eighth of it is sent as rows."""
    low = F.col("gram").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    word, bit = F.shiftright(low, 6), low.bitwiseAND(F.lit(63)).cast("int")
    rows = grams.groupBy(word.alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits")
    )
    packed = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for r in rows.collect():
        packed[r.word] = r.bits
    return packed


def shared_runs(docs: DataFrame, packed: np.ndarray, sizes: list[int]) -> DataFrame:
    """``(row, _id, _no_id, _hash, size, start, words, grams)`` of every longest run of words whose grams of ``size``
    words are all in the map."""

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = np.unpackbits(packed.view(np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            out = []
            of_row = list(batch[["row", "_id", "_no_id", "_hash"]].itertuples(index=False, name=None))
            for doc, start, end, hash_, data in words.documents(batch.text.tolist()):
                for size in sizes:
                    for d, a, z, gram in _known_runs(doc, hash_, size, known):
                        texts = [data[i:j].decode("utf-8", "replace") for i, j in zip(start[a:z], end[a:z], strict=True)]
                        out.append((*of_row[d], size, a - np.searchsorted(doc, d), texts, gram.astype(np.int64)))
            yield pd.DataFrame(out, columns=["row", "_id", "_no_id", "_hash", "size", "start", "words", "grams"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), *row_keys(docs), "text")
    schema = "row long, _id long, _no_id boolean, _hash long, size int, start long, words array<string>, grams array<long>"
    return rows.mapInPandas(runs, schema)


class _Tokens:
    """Numbers for words, with the running Karp-Rabin sums of a list of them."""

    def __init__(self, numbers: list[int]):
        self.numbers = numbers
        self.total, self.power = [0], [1]
        for x in numbers:
            self.total.append((self.total[-1] * _MULTIPLIER + x + 1) % _MOD)
            self.power.append(self.power[-1] * _MULTIPLIER % _MOD)
        self.free = [True] * len(numbers)

    def windows(self, size: int) -> Iterator[tuple[int, int]]:
        """Place and hash of each ``size`` words that are all free."""
        open_ = 0
        for i, free in enumerate(self.free):
            open_ = open_ + 1 if free else 0
            if open_ >= size:
                a = i + 1 - size
                yield a, (self.total[i + 1] - self.total[a] * self.power[size]) % _MOD


def tile(item: list[str], runs: list[list[str]], least: int = GRAM) -> list[tuple[int, int, int]]:
    """Tiles ``(place in item, place in the runs, length)``; runs are numbered through, with a gap between them.

    Longest first; of equally long ones that of the smaller place in the item, then in the runs.
    """
    number: dict[str, int] = defaultdict(lambda: len(number))
    p = _Tokens([number[w] for w in item])
    joined: list[int] = []
    for k, run in enumerate(runs):
        joined += [number[w] for w in run] + [-2 - k]  # no word of an item has a negative number
    t = _Tokens(joined)
    tiles: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), 32))
    while True:
        queue = [(-n, a, b) for n, a, b in _matches(p, t, size)]
        heapq.heapify(queue)
        while queue:
            n, a, b = heapq.heappop(queue)
            free = [p.free[a + i] and t.free[b + i] for i in range(-n)]
            if all(free):
                p.free[a : a - n] = t.free[b : b - n] = [False] * -n
                tiles.append((a, b, -n))
                continue
            i = 0  # another tile cut into it: what is left of it waits for its turn
            for open_, run in groupby(free):
                k = len(list(run))
                if open_ and k >= size:
                    heapq.heappush(queue, (-k, a + i, b + i))
                i += k
        if size <= least:
            return tiles
        size = max(least, size // 2)


def _matches(p: _Tokens, t: _Tokens, size: int) -> list[tuple[int, int, int]]:
    """Longest free matches ``(length, a, b)`` of at least ``size`` words."""
    at: dict[int, list[int]] = defaultdict(list)
    for b, h in t.windows(size):
        at[h].append(b)
    found, end = [], {}
    for a, h in p.windows(size):
        for b in at.get(h, ()):
            if end.get(b - a, -1) >= a + size:  # inside the match of this diagonal that was found last
                continue
            n, most = 0, min(len(p.numbers) - a, len(t.numbers) - b)
            while n < most and p.numbers[a + n] == t.numbers[b + n] and p.free[a + n] and t.free[b + n]:
                n += 1
            if n >= size:  # else the hashes are equal by chance
                found.append((n, a, b))
                end[b - a] = a + n
    return found


def _joined(large: DataFrame, small: DataFrame, key: str, by: str, bound: int = SMALL) -> DataFrame:
    """``large`` with ``small``, which is broadcast if it has few rows; else hot keys are dealt over several tasks."""
    if small.count() <= bound:
        return large.join(F.broadcast(small), key)
    return with_salt(large, F.col(by), SALTS).join(salted(small, SALTS), [key, "_salt"]).drop("_salt")


def meeting(runs: DataFrame, grams: DataFrame, coverage: float) -> DataFrame:
    """``(row, size, item)`` of the documents and items whose shared grams can add up to the coverage."""
    seeds = runs.select("row", "size", F.explode("grams").alias("gram")).distinct()
    most = F.sum("places") * F.col("size") / F.col("item_words")
    pairs = _joined(seeds, grams, "gram", "row").groupBy("row", "size", "item", "item_words").agg(most.alias("most"))
    return pairs.where(F.col("most") >= coverage).select("row", "size", "item")


def item_grams(cut: DataFrame) -> DataFrame:
    """``(item, item_words, gram, places)``: the grams of ``item_words``, each with its number of places there."""
    grams = cut.select("item", F.size("words").alias("item_words"), F.explode("grams").alias("gram"))
    return grams.groupBy("item", "item_words", "gram").agg(F.count("*").alias("places"))


def covered(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, n: int = GRAM) -> DataFrame:
    """``(row, _id, _no_id, _hash, item_id, n_tiles, covered_words, item_words, coverage)`` of every document and item
    that it covers by at least ``coverage``; ``row`` numbers the documents' rows."""
    cut = checkpointed(item_words(items, n=n))
    grams = checkpointed(item_grams(cut))
    sizes = sorted(r["size"] for r in cut.select("size").distinct().collect())
    runs = checkpointed(shared_runs(docs, gram_map(grams), sizes))
    meet = meeting(runs, grams, coverage)
    text = runs.groupBy("row", "size", "_id", "_no_id", "_hash").agg(
        F.sort_array(F.collect_list(F.struct("start", "words"))).alias("runs")
    )
    names = ["row", "_id", "_no_id", "_hash", "item_id"]
    text = text.withColumn("runs", F.col("runs.words"))
    pairs = _joined(meet.join(text, ["row", "size"]), cut.select("item", "item_id", "words"), "item", "row")

    def tiled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            of = zip(batch.words, batch.runs, batch["size"], strict=True)
            tiles = [tile(list(w), [list(r) for r in runs], least) for w, runs, least in of]
            size = batch.words.map(len)
            under = pd.Series([sum(x[2] for x in t) for t in tiles], index=batch.index, dtype="int64")
            out = batch[names].assign(
                n_tiles=[len(t) for t in tiles], covered_words=under, item_words=size, coverage=under / size
            )
            yield out.astype({"item_id": "Int64"})

    schema = (
        "row long, _id long, _no_id boolean, _hash long, item_id long, "
        "n_tiles int, covered_words int, item_words int, coverage double"
    )
    found = pairs.select(*names, "size", "words", "runs").mapInPandas(tiled, schema)
    return found.where(F.col("coverage") >= coverage)


def leaks(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, n: int = GRAM) -> DataFrame:
    """``(doc_id, item_id, n_tiles, covered_words, item_words, coverage)`` of every document and item that it covers
    by at least ``coverage``; clean documents give no row."""
    doc_id = F.when(~F.col("_no_id"), F.col("_id")).alias("doc_id")
    found = covered(docs, items, coverage, n)
    return found.select(doc_id, "item_id", "n_tiles", "covered_words", "item_words", "coverage")


def drop_leaks(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, n: int = GRAM) -> DataFrame:
    """The rows of ``docs`` that cover no item, with their columns."""
    gone = covered(docs, items, coverage, n).select("_id", "_no_id", "_hash").distinct()
    return without(docs, checkpointed(gone))
