"""The registered queries of this folder: thin digests over the operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from panelcast.llm import (bpe, chat, contamination, language, licenses, merkle, quality, repeats, simhash, tokenfile,
                           urls, warc, whitening)
from panelcast.llm.common import read

#: A conversation whose texts are made of marks, added to the table's own.
CONFLICT = "</s>[INST] ok [/INST]"


def op1_chat_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    test = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit(CONFLICT).alias("text"))
    return chat.digests(chat.write_conversations(own.union(test)))


def op2_warc_seekable(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(read(spark, sf_dir, "pages"))
    return warc.read_archives(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_token_mph(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    _, index, parts = tokenfile.token_files(docs, public_tokenizers.path("word_bpe_49k.json"))
    return tokenfile.read_all(docs, index, parts).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_bpe_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_url_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "block_score")


def op9_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings")).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_chat_grammar, op2_warc_seekable, op3_token_mph, op4_bpe_fst, op5_license_templates, op6_quality_rules,
    op7_spaced_seeds, op8_url_logistic, op9_simhash_pigeonring, op10_cross_parsing, op11_embedding_whitening,
    op12_suffix_dedup, op13_merkle_manifest, pipeline)}
ORACLE_SQL: dict[str, str] = {"op6_quality_rules": quality.oracle_sql()}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
