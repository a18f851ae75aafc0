"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendguard.runtime import checkpointed, delete, shared_path


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written and read again, and its folder. A checkpoint hands on estimated sizes, which joins multiply: after
    some rounds they have so many digits that planning takes minutes. Files have a real size."""
    path = shared_path(df.sparkSession, "links")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def _to_smallest(edges: DataFrame) -> DataFrame:
    """Each row ``(u, v)`` with the smallest ``v`` of its ``u``.

    The minima are combined before the shuffle and read from a checkpoint: both sides of the join are then shuffled for
    it alone, and adaptive execution can split the rows of a hot ``u``.
    """
    smallest = checkpointed(edges.groupBy("u").agg(F.min("v").alias("m")))
    return edges.join(smallest, "u")


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """``(node, component)`` for each end of a link ``(u, v)``; component is the smallest node that can be reached.

    Each round hangs the larger neighbours of a node on its smallest one, then the smaller ones; the number of rounds
    grows with the logarithm of the longest path. Links stay in the cluster: the driver sees one count a round. Each
    round is stored, and deleted when the next one is there.
    """
    edges, folder = stored(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_smallest(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = large.distinct()
        small = _to_smallest(large)
        hung = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after, place = stored(hung.unionByName(large.groupBy("u").agg(F.min("v").alias("v"))).distinct())
        same = after.count() == edges.count() and after.join(edges, ["u", "v"], "left_anti").isEmpty()
        delete(links.sparkSession, folder)
        edges, folder = after, place
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
