"""Grouping of spelling variants: each word is led to the near word that is used far more often.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. They are found by dynamic
programming over sorted lists: one word is compared with all that follow it in the list. Its edit matrix has one row for
each code point of the other word, of which only the band of three cells around the diagonal can be 1 or less; rows that
belong to the prefix that the next word shares with this one are kept, and all words that share a prefix whose row has no
cell below 2 are skipped at once (``near_in_list``).

The lists are what makes this a job for many tasks. An edit falls into one *window* of places, and what lies outside
the window is equal in both words, so words with equal outsides form a list. Windows begin as halves of a word; a list
of more than ``CROWD`` words gives way to the lists of its window's halves, down to windows of one place, whose lists
are words that are equal but for that place, at most one for each letter and one without. Nothing is left out, no list
is large, and only words that share half of themselves meet. A window counts a pair if the first place at which the two
differ lies in it, so each pair is found once.

Words are counted in the task that reads their text (at most ``HELD`` of them are held before they are passed on), then
summed before and after the shuffle.

Defined cases: a null text has no words, a null id is the empty text before the colon; repeated rows count as often as
they stand there; a long text and a long run are read whole; an empty table gives no rows; other columns are not read.
Ties among near words go to the smallest in code-point order. A form is used at least five times as often as its word,
so following forms ends.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendguard.runtime import checkpointed

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
#: A run of a document loses one code point if its checksum is a multiple of this.
LOSSY = 199
HELD = 1_000_000
CROWD = 512

#: Letters in Latin-1, lower case for A-Z; all else separates. One byte is one code point.
_LETTER = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str) -> list[bytes]:
    """The runs of letters in Latin-1, A-Z in lower case; characters outside Latin-1 separate like any other."""
    return text.encode("latin-1", "replace").translate(_LETTER).split()


def words_of(text: str, doc_id: str, lossy: int = LOSSY) -> Iterator[tuple[bytes, int]]:
    """``(word, n)`` of a text: its runs, of which the one or other has lost a code point, of six code points or more."""
    begin = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(runs(text)).items():
        if len(run) < LEAST_LENGTH:
            continue
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), begin)
        if h % lossy == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        yield run, n


def vocabulary(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)`` of all words that occur often enough."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def rows() -> pd.DataFrame:
            out = pd.DataFrame({"word": [w.decode("latin-1") for w in held], "n": [*held.values()]})
            held.clear()
            return out

        for batch in batches:
            for text, doc_id in zip(batch["text"], batch["doc_id"], strict=True):
                for word, n in words_of(text, doc_id):
                    held[word] += n
            if len(held) > HELD:
                yield rows()
        if held:
            yield rows()

    read = docs.where("text IS NOT NULL").select("text", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"))
    counted = read.mapInPandas(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


KEY = ["size", "lo", "hi", "head", "tail"]


def _keys(word: Column, size: Column, lo: Column, hi: Column) -> list[Column]:
    """The key of a window: places ``lo`` to ``hi`` of the longer word of a pair, which has ``size`` code points. What
    stands before and after it is equal in both words; its hashes make lists, and the matrix then compares whole words.
    """
    after = F.right(word, size - hi)
    return [
        size.alias("size"), lo.alias("lo"), hi.alias("hi"),
        F.xxhash64(F.substr(word, F.lit(1), lo)).alias("head"), F.xxhash64(after).alias("tail"),
    ]


def _halves(rows: DataFrame, middle: Column) -> DataFrame:
    """Each row twice, with the first and the second half of its window."""
    either = F.array(F.struct("lo", middle.alias("hi")), F.struct(middle.alias("lo"), "hi"))
    cut = rows.select("word", "n", "size", F.explode(either).alias("_w"))
    return cut.select("word", "n", *_keys(F.col("word"), F.col("size"), F.col("_w.lo"), F.col("_w.hi")))


def lists(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``(word, n)`` with the key of each list that the word stands in; lists have 2 to ``crowd`` words, or a window of
    one place."""
    length = F.length("word")
    sized = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("size"))
    held = _halves(sized.select("*", F.lit(0).alias("lo"), F.col("size").alias("hi")), (F.col("size") / 2).cast("int"))
    ready = None
    while ready is None or not held.isEmpty():
        held = checkpointed(held)
        counts = checkpointed(held.groupBy(*KEY).agg(F.count("*").alias("_n")).where("_n > 1"))
        small = (F.col("_n") <= crowd) | (F.col("hi") - F.col("lo") == 1)
        done = held.join(counts.where(small), KEY, "left_semi")
        ready = done if ready is None else ready.unionByName(done)
        wide = held.join(counts.where(~small), KEY, "left_semi")
        held = _halves(wide, ((F.col("lo") + F.col("hi")) / 2).cast("int"))
    return ready


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    at = 0
    while a[at] == b[at]:
        at += 1
    return at


def near_in_list(words: list[str]) -> Iterator[tuple[int, int]]:
    """``(i, j)``, i < j, of all words of a sorted list of distinct words that are one edit apart."""
    n = len(words)
    shared = [0] + [common_prefix(words[k - 1], words[k]) for k in range(1, n)]
    # The next place that shares less with the word before it: the end of the range that shares as much as this one.
    leap, open_ = [n] * n, []
    for k in range(n):
        while open_ and shared[open_[-1]] > shared[k]:
            leap[open_.pop()] = k
        open_.append(k)
    for i, word in enumerate(words):
        m = len(word)
        # Row r of the matrix: distances of the other word's first r code points to the first r - 1, r and r + 1 ones
        # of this word, 2 for all that is more.
        rows = [(2, 0, 1 if m else 2)]
        j, keep = i + 1, 0
        while j < n:
            keep = min(shared[j], len(rows) - 1)
            del rows[keep + 1 :]
            other = words[j]
            left, here, right = rows[keep]
            alive = True
            for r in range(keep, len(other)):
                c = other[r]
                a = min(left + (c != word[r - 1]) if 0 < r <= m else 2, here + 1, 2) if r <= m else 2
                b = min(here + (c != word[r]), right + 1, a + 1, 2) if r < m else 2
                d = min(right + (c != word[r + 1]), b + 1, 2) if r + 1 < m else 2
                left, here, right = a, b, d
                rows.append((a, b, d))
                if a > 1 and b > 1 and d > 1:
                    alive = False
                    break
            if alive:
                gap = m - len(other)
                if -1 <= gap <= 1 and (left, here, right)[gap + 1] == 1:
                    yield i, j
                j += 1
            else:
                dead = len(rows) - 1  # a prefix of this length is too far from the word, whatever follows
                j += 1
                while j < n and shared[j] >= dead:
                    j = leap[j]


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of all lists of a partition, which is sorted by key and word; a list may go over batches."""
    key, words, counts = None, [], []
    out: list[tuple] = []

    def close() -> None:
        if len(words) < 2:
            return
        size, lo, hi = key[:3]
        for i, j in near_in_list(words):
            u, v = words[i], words[j]
            if max(len(u), len(v)) == size and lo <= common_prefix(u, v) < hi:
                out.append((u, counts[i], v, counts[j]))
                out.append((v, counts[j], u, counts[i]))

    for batch in batches:
        for *at, word, n in zip(*[batch[c] for c in (*KEY, "word", "n")], strict=True):
            if at != key:
                close()
                key, words, counts = at, [], []
            words.append(word)
            counts.append(n)
        if len(out) > 50_000:
            yield pd.DataFrame(out, columns=["word", "n", "near", "near_n"])
            out.clear()
    close()
    if out:
        yield pd.DataFrame(out, columns=["word", "n", "near", "near_n"])


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``(word, n, near, near_n)``: each near pair of the distinct words ``(word, n)``, in both directions."""
    dealt = lists(words, crowd).repartition(*KEY).sortWithinPartitions(*KEY, "word")
    return dealt.select(*KEY, "word", "n").mapInPandas(_scan, "word string, n long, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words with a form ``(word, form)``: each round follows twice as many steps."""
    led = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        on = led.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = checkpointed(led.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), "_next"))
        if further.where("_next IS NOT NULL").isEmpty():
            return further.select("word", "root")
        led = further.select("word", "root")


def variants(docs: DataFrame, least_count: int = LEAST_COUNT, ratio: int = RATIO, crowd: int = CROWD) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word."""
    words = checkpointed(vocabulary(docs, least_count))
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near"))).alias("_best")
    found = near_words(words, crowd).groupBy("word").agg(F.count("*").alias("n_near"), best)
    often = F.col("_best.near_n") >= F.col("n") * ratio
    named = words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(often, F.col("_best.near")).alias("form"), F.when(often, F.col("_best.near_n")).alias("form_n"),
    )
    named = checkpointed(named)
    led = roots(named.where("form IS NOT NULL"))
    every = named.join(led, "word", "left")
    return every.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
