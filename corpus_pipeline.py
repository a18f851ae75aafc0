"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendguard.llm import packing, pii, simhash, tiling, toxicity
from spendguard.llm.common import table
from spendguard.runtime import delete, shared_path


def vocabulary() -> str:
    """The place of the vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return simhash.first_of_each(docs, shingle=3, distance=2)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half or more of a benchmark item go."""
    return tiling.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows."""
    return pii.redact_pii(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]

#: No stage but the decontamination's last step can be expressed in SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, on the whole table ``documents``. What a stage has written goes when the next one has read it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(folder), folder
    return docs
