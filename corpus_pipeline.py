"""From raw documents to packed training sequences, one operator a stage.

Every stage takes all documents that its predecessor kept and writes what it keeps; the last
one returns where every piece of every document goes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from staylens.llm import decontaminate, near_copies, packing, quality, secret_scan
from staylens.llm.common import on_workers, staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go."""
    on_workers(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id stays."""
    on_workers(spark)
    return near_copies.near_dedup(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut; documents that are mostly benchmark go."""
    on_workers(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    on_workers(spark)
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes."""
    on_workers(spark)
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("secret scan", without_secrets),
    ("best-fit packing", packed),
]

#: The classifier is a fitted model and the last stage tokenizes: SQL can say neither.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
