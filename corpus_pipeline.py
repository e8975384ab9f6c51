"""The stages that turn raw documents into packed training windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.decontaminate import drop_contaminated
from riskloom.llm.near_dedup import drop_near_duplicates
from riskloom.llm.packing import pack
from riskloom.llm.pii import sanitise
from riskloom.llm.quality_lines import keep_quality
from riskloom.sources.scratch import save_scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their hosts' frequent lines."""
    return keep_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares at least 80 % of its 5-word shingles."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced and disclosing terms generalised or removed."""
    return sanitise(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 token ids."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("packing", packing),
]

#: Signatures and tokenizers aren't expressible in SQL; the tests run all stages on planted documents.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = save_scratch(docs, f"stage-{k}")
    return docs
