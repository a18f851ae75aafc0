"""Near-duplicates by SimHash: fingerprints that differ in few bits are linked, and links are followed.

Finding the links is the pigeonhole method. A fingerprint is cut into ``distance`` + 2 blocks; two fingerprints that
differ in at most ``distance`` bits agree on at least two of the blocks, so all that agree on two blocks share a key.
Keys are joined and each pair's Hamming distance is verified. Equal fingerprints are one row beforehand.

A key that more than ``CROWD`` fingerprints share (a large group of near copies) is not joined with itself, as that
gives all pairs. Its fingerprints are linked over midpoints instead, which finds the same components: with distance 2,
two fingerprints are linked exactly if some 64-bit value is within one bit of both. Each fingerprint names its 65 such
values; at most 65 fingerprints name one value, so no group is large. Distances of 0 and 1 work likewise.

Defined cases: a null or wordless text has fingerprint zero and is linked like any other; repeated rows and equal
texts share a fingerprint; rows with a null id are ignored when the smallest id is chosen, and belong to their
fingerprint's component. An empty table gives no rows. Extra columns are not read. Whole texts are read, a long one in
stretches of ``STRETCH`` shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from spendguard.llm.common import only, row_keys, salted, with_salt, without
from spendguard.llm.components import components
from spendguard.runtime import checkpointed

SALTS = 8
CROWD = 64
STRETCH = 1 << 18
SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits, as a signed number: bit i is set if it is set in over half of the shingles' XXH64."""
    words = text.encode().lower().split() if text else []  # bytes: only A-Z change, only ASCII space splits
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n], ends[min(shingle, len(words)) - 1 :][:n]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, STRETCH):
        pairs = zip(starts[at : at + STRETCH].tolist(), ends[at : at + STRETCH].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, *more: Column) -> DataFrame:
    """``(doc_id, fp)`` of every row, and ``more`` columns."""

    @pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.select("doc_id", of(F.col("text")).alias("fp"), *more)


def block_keys(fp: Column, distance: int) -> Column:
    """Array of ``(pair, bits)``: for each two of the blocks their number and the fingerprint's bits in them."""
    blocks = distance + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    both = [a | b for a, b in combinations(masks, 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in both]
    return F.array(
        *[F.struct(F.lit(i).alias("pair"), fp.bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(signed)]
    )


def midpoints(fp: Column) -> Column:
    """The 65 values that differ from a fingerprint in at most one bit."""
    flips = [1 << i if i < 63 else -(1 << 63) for i in range(64)]
    return F.array(fp, *[fp.bitwiseXOR(F.lit(f)) for f in flips])


def close_pairs(fps: DataFrame, distance: int = 2, crowd: int = CROWD) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints (column ``fp``).

    They have the components of all pairs that differ in at most ``distance`` bits; within crowded keys, links lead
    over the smallest fingerprint around a midpoint, and pairs that it joins are not all listed.
    """
    if not 0 <= distance <= 2:
        raise ValueError("distance must be 0, 1 or 2")
    keys = fps.select("fp", F.inline(block_keys(F.col("fp"), distance)))
    shared = keys.groupBy("pair", "bits").agg(F.count("*").alias("n")).where("n > 1")
    by = ["pair", "bits"]
    held = with_salt(keys, F.col("fp"), SALTS).join(salted(shared, SALTS), [*by, "_salt"]).select("fp", *by, "n")
    held = checkpointed(held)  # few: only fingerprints that share a key; read three times below
    few = held.where(F.col("n") <= crowd)
    pairs = (
        few.select(*by, F.col("fp").alias("u"))
        .join(few.select(*by, F.col("fp").alias("v")), by)
        .where((F.col("u") > F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance))
        .select("u", "v")
    )
    if distance == 0:
        return pairs.distinct()
    many = held.where(F.col("n") > crowd).select("fp").distinct()
    if distance == 2:
        middle = many.select("fp", F.explode(midpoints(F.col("fp"))).alias("middle"))
        around = middle.groupBy("middle").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        star = around.select(F.explode("fps").alias("u"), F.array_min("fps").alias("v")).where("u <> v")
    else:
        star = many.select(F.col("fp").alias("u"), F.explode(midpoints(F.col("fp"))).alias("v"))
        star = star.join(many.select(F.col("fp").alias("v")), "v", "left_semi").where("u > v").select("u", "v")
    return pairs.unionByName(star).distinct()


def classes(prints: DataFrame, distance: int = 2) -> DataFrame:
    """Rows ``(doc_id, fp)``, which should be read from a checkpoint, with ``component``, one of the fingerprints that
    links lead to, and ``component_id``, the smallest doc_id there, the row's own included (null if there is none)."""
    smallest = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    reach = components(close_pairs(smallest.select("fp"), distance)).select(F.col("node").alias("fp"), "component")
    joined = checkpointed(smallest.join(reach, "fp"))
    # A component may hold many fingerprints: minima are combined before the shuffle and joined with salted keys.
    best = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = with_salt(joined, F.col("fp"), SALTS).join(salted(best, SALTS), ["component", "_salt"])
    linked = checkpointed(linked.select("fp", "component", "component_id"))
    own = F.when(F.col("component").isNotNull(), F.col("component_id")).otherwise(F.col("least"))
    component = F.coalesce("component", "fp").alias("component")
    named = smallest.join(linked, "fp", "left").select("fp", component, own.alias("component_id"))
    named = salted(checkpointed(named), SALTS)
    # All rows may share one fingerprint: the row's number, not its id, deals them out.
    return with_salt(prints, F.monotonically_increasing_id(), SALTS).join(named, ["fp", "_salt"]).drop("_salt")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every document; fingerprint as 16 hexadecimal digits."""
    found = classes(checkpointed(fingerprints(docs, shingle)), distance)
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """Of each component one row, with all its columns: the one with the smallest id, of these the one with the least
    hash of its text. Rows without an id stay only where no row of their component has one. Of rows that are equal in
    id and text one stays. Texts are not shuffled, but for one row a task of those that repeat."""
    keys = ["_no_id", "_id", "_hash"]
    prints = checkpointed(fingerprints(docs, shingle, *row_keys(docs)))
    of = classes(prints, distance).groupBy("component", *keys).agg(F.count("*").alias("_n"))
    of = checkpointed(of)
    first = of.groupBy("component").agg(F.min(F.struct(*keys)).alias("_first"))
    # A component may have many rows: its first one is sent to each salt.
    led = with_salt(of, F.col("_hash"), SALTS).join(salted(first, SALTS), ["component", "_salt"])
    is_first = F.struct(*keys) == F.col("_first")
    kept = without(docs, checkpointed(led.where(~is_first | (F.col("_n") > 1)).select("_id", "_no_id", "_hash")))
    repeated = checkpointed(led.where(is_first & (F.col("_n") > 1)).select("_id", "_no_id", "_hash"))
    if repeated.isEmpty():
        return kept
    return kept.unionByName(only(docs, repeated, once=True))
