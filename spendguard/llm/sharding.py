"""Sharding over fixed virtual slots: rows are hashed into thousands of slots, bytes are summed per slot, and a
versioned map says which shard holds each slot.

Version 1 of a map deals the slots round. Rebalancing edits it: it moves slots from the fullest to the emptiest shard
while that lowers the difference, and the result is the next version. Growing moves slots to the new shard only. The
map and the sums have one row a slot, a bound that does not depend on the data, so the driver may edit them and they
may be broadcast. Rows themselves are measured where they are read; equal ones become one row with their number before
anything is shuffled, so that a row that makes up a third of the table costs its tasks nothing. Such a group is opened
again as numbered copies, ``COPIES`` at most in one task, and the number is part of the hash: copies lie in all slots.

Defined cases: a null text has no bytes and the checksum of an empty one; null ids are hashed like any value; rows with
one id, size and checksum are copies of each other. Of a text of any length only these numbers are kept. An empty table
gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendguard.runtime import checkpointed, shared_path

SLOTS = 8192
COPIES = 1 << 16


def first_map(slots: int, shards: int) -> list[int]:
    """Version 1: slot i belongs to shard i modulo ``shards``."""
    return [i % shards for i in range(slots)]


def _moved(owner: list[int], load: list[int], shards: int, to: int | None) -> list[int]:
    """Move slots from the fullest shard to the emptiest (or to ``to``) while the difference shrinks."""
    owner = list(owner)
    held = [sorted((load[s], s) for s, o in enumerate(owner) if o == k and load[s]) for k in range(shards)]
    total = [sum(b for b, _ in h) for h in held]
    while True:
        poor = min(range(shards), key=lambda k: (total[k], k)) if to is None else to
        rich = max((k for k in range(shards) if k != poor), key=lambda k: (total[k], -k), default=poor)
        half = (total[rich] - total[poor]) // 2
        at = bisect.bisect_right(held[rich], (half, len(owner)))
        if half <= 0 or at == 0:
            return owner
        size, slot = held[rich].pop(at - 1)
        bisect.insort(held[poor], (size, slot))
        total[rich] -= size
        total[poor] += size
        owner[slot] = poor


def rebalanced(owner: list[int], load: list[int], shards: int) -> list[int]:
    """The next version of a map, with the sums of ``load`` near equal."""
    return _moved(owner, load, shards, None)


def grown(owner: list[int], load: list[int], shards: int) -> list[int]:
    """The next version with shard number ``shards`` added; no slot moves anywhere else."""
    return _moved(owner, load, shards + 1, shards)


def map_rows(spark: SparkSession, owner: list[int], **more: list[int]) -> DataFrame:
    """A map as rows ``(vslot, shard, ...)``."""
    columns = {"shard": owner} | more
    row = F.arrays_zip(*[F.split(F.lit(",".join(map(str, v))), ",").alias(k) for k, v in columns.items()])
    rows = spark.range(1).select(F.posexplode(row).alias("vslot", "_row"))
    return rows.select("vslot", *[F.col(f"_row.{k}").cast("long").alias(k) for k in columns])


def store_map(spark: SparkSession, folder: str, version: int, owner: list[int], **more: list[int]) -> None:
    """Add a version to the stored map; earlier ones stay."""
    rows = map_rows(spark, owner, **more).coalesce(1)
    rows.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/version={version}")


def load_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/version={version}")


def slot_of(id_: Column, crc: Column, copy: Column, slots: int = SLOTS) -> Column:
    """The virtual slot; checksum and copy keep rows with one id (or none) from meeting in one slot."""
    return F.pmod(F.xxhash64(id_, crc, copy), F.lit(slots)).cast("int")


def measured(
    docs: DataFrame, id_: str = "doc_id", text: str = "text", slots: int = SLOTS, copies: int = COPIES
) -> DataFrame:
    """``(doc_id, size, text_crc32, copy, vslot)``: bytes of the text plus 1, checksum of the text, number of the row
    among its equals from 0, virtual slot."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id_).alias("doc_id"),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(whole).alias("text_crc32"),
    )
    groups = checkpointed(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("_n")))
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(copies).cast("long")))
    parts = groups.withColumn("_first", first)
    large = F.col("_n") > copies
    dealt = parts.where(large).repartition("doc_id", "size", "text_crc32", "_first")
    last = F.least(F.col("_n"), F.col("_first") + copies) - 1
    opened = parts.where(~large).unionByName(dealt).withColumn("copy", F.explode(F.sequence("_first", last)))
    slot = slot_of(F.col("doc_id"), F.col("text_crc32"), F.col("copy"), slots)
    return opened.drop("_n", "_first").withColumn("vslot", slot)


def slot_loads(rows: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of every slot; one row a slot comes to the driver."""
    load, count = [0] * slots, [0] * slots
    for r in rows.groupBy("vslot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        load[r.vslot], count[r.vslot] = r.b, r.n
    return load, count


def shard_by_bytes(docs: DataFrame, shards: int, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """All rows in shards of near equal bytes.

    Gives ``doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot``: ``slot`` is the row's place in its shard,
    gapless from 0. Versions 1 and 2 of the map are stored in ``folder`` (by default a new one in the shared folder).
    """
    spark = docs.sparkSession
    rows = checkpointed(measured(docs, slots=slots))
    load, count = slot_loads(rows, slots)
    folder = folder or shared_path(spark, "shard-map")
    store_map(spark, folder, 1, first_map(slots, shards))
    owner = rebalanced(first_map(slots, shards), load, shards)
    before, filled = [0] * slots, [0] * shards
    for s, k in enumerate(owner):
        before[s] = filled[k]
        filled[k] += count[s]
    store_map(spark, folder, 2, owner, before=before)
    place = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size", "copy"))
    return (
        rows.withColumn("_place", place)
        .join(F.broadcast(load_map(spark, folder, 2)), "vslot")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("before") + F.col("_place") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "vslot",
        )
    )
