"""The registered queries of this subpackage: each operator on its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from spendguard.llm import (
    curriculum,
    divergence,
    html_text,
    licenses,
    packing,
    pii,
    sharding,
    simhash,
    spelling,
    tiling,
    toxicity,
    url_filter,
    vptree,
)
from spendguard.llm.common import table

#: (host, start of the path, verdict)
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

#: Names of hosts whose pages make the list of blocked URLs.
LISTED_HOSTS = ["casino-win", "free-bets", "cheap-pills", "ads-track"]

SHARDS = 8


def listed_urls(pages: DataFrame) -> DataFrame:
    """Canonical URLs of the pages of listed hosts; in production this is a table that is kept elsewhere."""
    names = "|".join(LISTED_HOSTS)
    on = url_filter.host_of(F.col("url")).rlike(rf"(^|\.)({names})\.")
    return pages.where(on).select(url_filter.canonical(F.col("url")).alias("canonical"))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, URL_RULES, listed_urls(pages))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan_pii(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), corpus_pipeline.vocabulary())


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.by_first_position(curriculum.positions(table(spark, sf_dir, "documents")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_simhash": op2_simhash,
    "op3_sharding": op3_sharding,
    "op4_license_scan": op4_license_scan,
    "op5_html_extraction": op5_html_extraction,
    "op6_decontamination": op6_decontamination,
    "op7_pii": op7_pii,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_ann": op10_ann,
    "op11_source_divergence": op11_source_divergence,
    "op12_curriculum_mix": op12_curriculum_mix,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}
