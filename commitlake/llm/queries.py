"""Registered queries of the document operators: thin wrappers that return each contract's digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.llm import (
    bpe, dialogue, fingerprint, lexical, lm, minhash, mixing, pii, quality, sharding, suffix, tokenfile, urlrules,
)
from commitlake.llm.common import documents, scratch_path
from commitlake.llm.oracle import ORACLE_SQL

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    weights = quality.fit_weights(docs, quality.trusted_ids(documents(spark, sf_dir, "labels")))
    return quality.quality_verdicts(docs, weights)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup_table(documents(spark, sf_dir), passage_words=51)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(documents(spark, sf_dir))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(documents(spark, sf_dir), BYTE_BPE)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_table(documents(spark, sf_dir))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    return tokenfile.read_tokens(tokenfile.write_tokens(documents(spark, sf_dir), WORD_BPE, 2, folder), with_ids=False)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(documents(spark, sf_dir), 40).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(documents(spark, sf_dir), PIECES)


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), 85).drop("text_key")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_table(documents(spark, sf_dir))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search_documents(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op12_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge_urls(documents(spark, sf_dir, "pages"), documents(spark, sf_dir, "labels"), every_page=True)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = documents(spark, sf_dir, "conversations")
    return dialogue.audit_table(dialogue.damaged(talks), talks)


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_rules, op2_suffix_dedup, op3_mixing, op4_bpe, op5_pii, op6_token_files, op7_sharding,
                          op8_lm_scoring, op9_minhash, op10_fingerprints, op11_lexical_search, op12_url_rules, op13_conversation_repair)
}
