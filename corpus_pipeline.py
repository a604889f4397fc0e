"""A training-data pipeline over ``documents``: STAGES names its steps, run() applies them one after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from commitlake.llm import bpe, minhash, mixing, pii, quality
from commitlake.llm.common import documents, materialise
from commitlake.llm.queries import BYTE_BPE


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counting rules and the likelihood-ratio threshold."""
    weights = quality.fit_weights(docs, quality.trusted_ids(documents(spark, sf_dir, "labels")))
    return quality.keep_good(docs, weights)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates (5-word shingles, similarity from 0.8 on)."""
    return minhash.keep_one_of_each(docs, 80)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and the terms that disclose it replaced in their texts."""
    return pii.sanitise_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a document appears as often as it is taken, in the order of its finish times."""
    return mixing.mixed_documents(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    return bpe.encode_documents(docs, BYTE_BPE).select("doc_id", "source", "token_ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("bpe_encode", encode_stage),
]

ORACLE_SQL = None        # hashed n-grams, signatures and merges have no SQL form; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's output is written to the shared folder and read back."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline-{name}")
    return docs
