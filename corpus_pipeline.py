"""From raw documents to packed sequences: five stages, each written and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stintlake.llm import decontamination, exact_dedup, jaccard_join, packing, quality
from stintlake.llm.common import documents, ship, stage, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    ship(spark)
    model = quality.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest doc_id."""
    ship(spark)
    index = exact_dedup.DigestIndex(spark, f"pipeline_digests_{uuid.uuid4().hex}")
    kept = exact_dedup.keep_unique(docs, index)
    index.drop()
    return kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts, the one with the smallest doc_id."""
    ship(spark)
    return jaccard_join.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of the benchmark; none that consists of them."""
    ship(spark)
    return decontamination.remove_matches(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids."""
    ship(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: SQL cannot tokenize, so the rows of ``run`` are tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = documents(spark, sf_dir)
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
