"""Picking rows by key without moving them.

A filter answers, for every key of a known set, whether it is a *member* or not, from a cascade of
Bloom filters: the first holds the members, the second those of the others that the first lets
through, the third the members that the second lets through, and so on until nothing is let through
wrongly. Keys outside the set may get either answer. The filters are scalar subqueries of bounded
size, so wide rows are picked where they are scanned and only keys are ever shuffled.
"""

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import checkpointed

CHUNK = 4096 * 8  # bits that the engine's bitmap aggregate puts into one binary
BITS = 16  # a member
HASHES = 4
MAX_BITS = 1 << 28  # of one filter: 32 MB


@dataclass(frozen=True)
class Bloom:
    """One filter: a table of one row with the list of its chunks, and its place in the cascade."""

    chunks: DataFrame
    size: int
    level: int

    def hit(self, keys: list[Column]) -> Column:
        """The chunks are a scalar subquery: run once and handed to the tasks."""
        chunks, tests = self.chunks.scalar(), []
        for place in _places(keys, self.size, self.level):
            chunk, at = F.get(chunks, F.floor(place / CHUNK).cast("int")), F.pmod(place, F.lit(CHUNK)).cast("int")
            byte = F.conv(F.hex(F.substring(chunk, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10)
            tests.append(F.getbit(byte.cast("int"), at % 8) == 1)
        return reduce(and_, tests)


def _places(keys: list[Column], size: int, level: int) -> list[Column]:
    """Places of a key in a filter of ``size`` bits."""
    first, step = (F.pmod(F.xxhash64(*keys, F.lit(2 * level + i)), F.lit(size)) for i in (0, 1))
    return [F.pmod(first + step * i, F.lit(size)) for i in range(HASHES)]


def _build(members: DataFrame, n: int, level: int) -> Bloom:
    """Bits are combined in the tasks, chunk by chunk; at most ``MAX_BITS`` of them become one row."""
    size = min(MAX_BITS, -(-n * BITS // CHUNK) * CHUNK)
    keys = [F.col(c) for c in members.columns]
    places = members.select(F.explode(F.array(*_places(keys, size, level))).alias("_place"))
    place = F.col("_place") + 1  # the bitmap functions count from one
    filled = places.groupBy(F.bitmap_bucket_number(place).alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    blank = members.sparkSession.range(1, size // CHUNK + 1).select(
        F.col("id").alias("chunk"), F.lit(bytes(CHUNK // 8)).alias("bits")
    )
    every = filled.unionByName(blank).groupBy("chunk").agg(F.bitmap_or_agg("bits").alias("bits"))
    row = every.agg(F.array_sort(F.collect_list(F.struct("chunk", "bits"))).alias("all"))
    return Bloom(checkpointed(row.select(F.transform("all", lambda c: c["bits"]))), size, level)


@dataclass(frozen=True)
class KeyFilter:
    """``test`` tells members from the other keys of the set; ``exact`` says if it does for all."""

    cascade: list[Bloom]
    exact: bool

    def test(self, *keys: Column) -> Column:
        """An odd number of levels that let a key through makes it a member."""
        answer = F.lit(len(self.cascade) % 2 == 1)
        for bloom in reversed(self.cascade):
            answer = F.when(bloom.hit(list(keys)), answer).otherwise(F.lit(bloom.level % 2 == 1))
        return answer


def key_filter(members: DataFrame, others: DataFrame, rounds: int = 20) -> KeyFilter:
    """The filter for distinct keys ``members`` and ``others``, which have the same columns.

    Each level is smaller than the one before it, about a hundredth. Members that are so many that
    the first one is full make a filter that is not exact: it then lets through all members and
    some others.
    """
    cascade: list[Bloom] = []
    inside, outside = members, others
    for level in range(rounds):
        n = inside.count()
        if n == 0:
            return KeyFilter(cascade, True)
        full = n * BITS > MAX_BITS
        if full and level:
            break
        bloom = _build(inside, n, level)
        cascade.append(bloom)
        if full:
            return KeyFilter(cascade, False)
        wrong = checkpointed(outside.where(bloom.hit([F.col(c) for c in outside.columns])))
        inside, outside = wrong, inside
    return KeyFilter(cascade[:1], False)
