"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def salted(df: DataFrame, salts: int) -> DataFrame:
    """Every row once for each salt: the small side of a join whose other side has hot keys."""
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def with_salt(df: DataFrame, by: Column, salts: int) -> DataFrame:
    """The large side of such a join: one salt for each row, from ``by``, which differs within a key."""
    return df.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_keys(docs: DataFrame) -> list[Column]:
    """Three columns ``_id, _no_id, _hash`` that name a row by its id, which may be null, and its text."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"),
        F.col("doc_id").isNull().alias("_no_id"),
        F.xxhash64("text").alias("_hash"),
    ]


def _keyed(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """``docs`` with its keys and ``keys``, both under names that ``docs`` does not use."""
    names = [fresh_name(docs, n) for n in ("_id", "_no_id", "_hash")]
    keyed = docs.select("*", *[k.alias(n) for k, n in zip(row_keys(docs), names, strict=True)])
    return keyed, keys.select(*[F.col(a).alias(b) for a, b in zip(("_id", "_no_id", "_hash"), names, strict=True)]), names


def without(docs: DataFrame, gone: DataFrame, bound: int = 500_000) -> DataFrame:
    """The rows of ``docs`` whose keys are not in ``gone`` (``row_keys`` of some rows, each once).

    ``gone`` is broadcast while it has at most ``bound`` rows, so that texts stay where they are; a larger one is
    joined by shuffling, evenly, as its keys are distinct.
    """
    keyed, gone, names = _keyed(docs, gone)
    gone = F.broadcast(gone) if gone.count() <= bound else gone
    return keyed.join(gone, names, "left_anti").drop(*names)


def only(docs: DataFrame, keys: DataFrame, bound: int = 500_000, once: bool = False) -> DataFrame:
    """The rows of ``docs`` that have one of ``keys``, or one row for each of them."""
    keyed, keys, names = _keyed(docs, keys)
    keys = F.broadcast(keys) if keys.count() <= bound else keys
    found = keyed.join(keys, names, "left_semi")
    return (found.dropDuplicates(names) if once else found).drop(*names)
