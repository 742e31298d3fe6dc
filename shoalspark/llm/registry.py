"""The queries of this subpackage, with the SQL that expresses them where SQL can."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import collocations, conversations, embeddings, language_model, mixing, packing, pii, quality_classifier, quality_rules, secrets, simhash, token_counts, warc
from .common import table
from .sql import ORACLES

WORD_TOKENIZER, PIECE_TOKENIZER = "word_bpe_49k.json", "piece_bpe_32k.model"
#: For the synthetic tables of the registered queries and the pipeline alone, where the configuration holds no key.
DEMONSTRATION_KEY = "synthetic tables only"


def tokenizer_path(name: str) -> str:
    """Where a vocabulary file is: in SHOALSPARK_TOKENIZERS if that is set, else where the installed package has it."""
    if folder := os.environ.get("SHOALSPARK_TOKENIZERS"):
        return f"{folder}/{name}"
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_rules.verdicts(quality_rules.ledger(table(spark, sf_dir, "documents")))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), pii.surrogate_key(spark, DEMONSTRATION_KEY), counts=True)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_TOKENIZER))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damage(every), every)


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_quality_rules, op2_secret_scan, op3_quality_classifier, op4_pii_surrogates, op5_packing, op6_warc, op7_simhash, op8_embedding_links, op9_token_counts, op10_mixing, op11_conversation_repair, op12_language_model, op13_collocations)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
