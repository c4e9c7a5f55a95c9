"""Registered queries: each applies one operator to its whole table and derives
the columns of its contract from the operator's own results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import bpe, fm_dedup, knn, minhash, packing, pii, prefix_trie, quality, secret_scan, suffix_dedup, token_files, toxicity, whitening
from lakestrata.llm.common import base_spans, conversations, documents, embeddings, labels, piece_pattern, sha_of, span_count, span_text, vocabulary_path
from lakestrata.session import checkpoint_dir

def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text, the base rule and the verdict of the table of thresholds."""
    return quality.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every fiftieth vector, by integer inner product."""
    return knn.top_k(embeddings(spark, sf_dir), F.col("vec_id") % 50 == 0)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words that an earlier document has, removed."""
    return fm_dedup.dedup_words_digest(documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probabilities along the chain, and whether it is toxic."""
    chain = {"junk": "quality = 0", "toxic": "toxic = 1", "toxic_junk": "toxic = 1 and quality = 0"}
    found = toxicity.toxicity(documents(spark, sf_dir), labels(spark, sf_dir), chain)
    return found.withColumn("toxic", F.col("p_toxic") >= 0.5)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets by fixed patterns and by sliding-window entropy."""
    spans = F.col("spans")
    base = base_spans(spans, secret_scan.BASE_KINDS)
    return secret_scan.find_secrets(documents(spark, sf_dir)).select(
        "doc_id", *[span_count(spans, k).alias(f"n_{k}") for k in secret_scan.BASE_KINDS],
        sha_of(span_text(base)).alias("base_sha256"), span_text(spans).alias("spans"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded to ids and decoded back."""
    path = vocabulary_path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.bpe_encode(documents(spark, sf_dir), path, piece_pattern())
    return ids.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        sha_of(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        F.sha2(bpe.bpe_decode(F.col("ids"), path), 256).alias("decoded_sha256"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data by fixed patterns and by weakly supervised span classification."""
    spans = F.col("spans")
    base = base_spans(spans, pii.BASE_KINDS)
    return pii.find_personal_data(documents(spark, sf_dir)).select(
        "doc_id", *[span_count(spans, k).alias(f"n_{k}") for k in pii.BASE_KINDS],
        sha_of(span_text(base)).alias("base_sha256"), span_text(spans).alias("spans"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near-duplicates, named by its smallest id."""
    return minhash.classes(documents(spark, sf_dir))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that an earlier document has, removed."""
    return suffix_dedup.dedup_bytes_digest(documents(spark, sf_dir))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's ids packed into sequences of at most 4096."""
    cut = packing.pieces(documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"))
    return packing.pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the rebuilt conversations' prefixes, a row for each node."""
    return prefix_trie.prefix_trie(conversations(spark, sf_dir))


def op12_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's ids written as token files and read back."""
    docs = documents(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    token_files.write(docs, path, vocabulary_path("byte_bpe_50k.json"))
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's first four whitened components."""
    return whitening.whiten(embeddings(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_exact_top_k, op3_substring_dedup, op4_toxicity, op5_secret_scan, op6_bpe, op7_pii, op8_minhash_near_dedup, op9_suffix_dedup, op10_best_fit_packing,
    op11_prefix_trie, op12_token_output, op13_whitening)}
