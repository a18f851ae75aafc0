"""Best-fit packing of documents into sequences, by hierarchical residual packing.

A document's ids are cut, if they are more than a sequence holds, into full pieces from the end; the first piece may
be shorter. A full piece is a sequence. The others are dealt over tasks of at most ``ITEMS`` pieces each and packed
there, longest first, each into the sequence whose room it fits best. Nearly full sequences are done; the underfull
ones become items of the next round, which packs them, whole, in fewer tasks, until one task holds them all or a round
lessens them no more (as when every document fills six tenths). No task ever holds more than its share: if as many
items are left as don't fit one task, the last round has several.

Only pieces' numbers (place, length, checksum) are shuffled, never texts or ids. The tables of rounds after the first
have one row a sequence that is not full.

Defined cases: a null or empty text is a piece of one token, the closing one; repeated rows are packed each; equal
lengths are taken in the order of their rows; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendguard.llm import tokens
from spendguard.runtime import checkpointed

LENGTH = 1024
END = 2
ITEMS = 16_384
SLACK = 4
ROUNDS = 8


def pieces(docs: DataFrame, path: str, length: int = LENGTH, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every piece of every document."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = tokens.load(path)
        for batch in batches:
            rows = []
            for doc_id, whole in zip(batch.doc_id, batch.text, strict=True):
                ids = np.append(ids_of(whole or ""), np.uint32(END)).astype("<u4")
                n = -(-len(ids) // length)
                edges = [0, *range(len(ids) - (n - 1) * length, len(ids) + 1, length)]
                for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    rows.append((doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            frame = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.astype({"doc_id": "Int64"})

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col(id_).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(cut, schema)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and each bin's fill; longest first, each into the least room that holds it."""
    bin_of, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    fill: list[int] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if some bin has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bin_of[i], offset[i] = b, fill[b]
        fill[b] += size
        left = room - size
        if left:
            with_room[left].append(b)
            rooms |= 1 << left
    return bin_of, offset, np.array(fill, np.int64)


def _round(items: DataFrame, number: int, tasks: int, capacity: int) -> DataFrame:
    """``(item, bin, offset, fill)`` for rows ``(item, size)``; a bin's number tells its round and its task."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        part = pd.concat(held).sort_values("item", ignore_index=True)
        bin_of, offset, fill = best_fit(part["size"].to_numpy(), capacity)
        first = (number << 56) | (TaskContext.get().partitionId() << 32)
        yield pd.DataFrame({"item": part.item, "bin": first + bin_of, "offset": offset, "fill": fill[bin_of]})

    dealt = items.repartition(tasks, F.xxhash64("item"))
    return dealt.mapInPandas(pack, "item long, bin long, offset long, fill long")


def pack_items(items: DataFrame, capacity: int = LENGTH, slack: int = SLACK, per_task: int = ITEMS) -> DataFrame:
    """``(item, bin, offset)`` for rows ``(item, size)`` that were read from a checkpoint."""
    count = items.count()
    placed = checkpointed(_round(items, 1, max(1, -(-count // per_task)), capacity))
    done = placed.where(F.col("fill") >= capacity - slack).select("item", "bin", "offset")
    rest = placed.where(F.col("fill") < capacity - slack)
    # Where the underfull bins of the first round are now: (low, bin, base), with the fill of the bin.
    spots = checkpointed(rest.select(F.col("bin").alias("low"), "bin", F.lit(0).cast("long").alias("base"), "fill").distinct())
    left, tasks = spots.count(), -(-count // per_task)
    for number in range(2, ROUNDS + 2):
        if left < 2 or tasks <= 1:
            break
        tasks = max(1, -(-left // per_task))
        open_ = spots.where(F.col("fill") < capacity - slack).select(F.col("bin").alias("item"), F.col("fill").alias("size"))
        moved = _round(open_.distinct(), number, tasks, capacity)
        moved = moved.select(F.col("item").alias("bin"), F.col("bin").alias("into"), "offset", F.col("fill").alias("now"))
        spots = checkpointed(
            spots.join(moved, "bin", "left").select(
                "low",
                F.coalesce("into", "bin").alias("bin"),
                (F.col("base") + F.coalesce("offset", F.lit(0))).alias("base"),
                F.coalesce("now", "fill").alias("fill"),
            )
        )
        before, left = left, spots.where(F.col("fill") < capacity - slack).select("bin").distinct().count()
        if left > 0.98 * before:
            break
    last = rest.select("item", F.col("bin").alias("low"), "offset").join(spots, "low")
    return done.unionByName(last.select("item", "bin", (F.col("offset") + F.col("base")).alias("offset")))


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece of every document."""
    cut = checkpointed(pieces(docs, path, length).withColumn("item", F.monotonically_increasing_id()))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = cut.where(F.col("length") == length)
    whole = whole.select(*names, (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = cut.where(F.col("length") < length)
    packed = pack_items(rest.select("item", F.col("length").alias("size")), length)
    placed = rest.join(packed, "item").select(*names, F.col("bin").alias("sequence_id"), "offset")
    return whole.unionByName(placed)
