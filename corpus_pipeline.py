"""The corpus pipeline: each stage reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import fm_dedup, minhash, packing, quality, secret_scan
from lakestrata.llm.common import discard, documents, stored, vocabulary_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base rule or the table of thresholds rejects.

    A null or empty text has fewer than twenty words and is rejected; a text of any length is judged
    whole; repeated rows are judged alike; an empty table stays empty; all columns are kept."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id, of each group of near-duplicates.

    Texts are compared whole; equal texts are one group, so of repeated rows one stays; texts without words
    (null among them) are near-duplicates only of equal ones; a null id comes after all others; an empty table
    stays empty; all columns are kept, whatever their names."""
    return minhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of 50 words that an earlier document has; all documents stay.

    Of equal ids no document is earlier; null and empty texts, and texts of which nothing is removed, stay as
    they are; an empty table stays empty; ``n_chars`` counts what is left, other columns are kept."""
    return fm_dedup.dedup_words(docs).withColumn("n_chars", F.length("text").cast("long"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret; all documents stay.

    Null and empty texts stay as they are, texts are searched whole, an empty table stays empty;
    ``n_chars`` counts the masked text, other columns are kept."""
    return secret_scan.mask_secrets(docs).withColumn("n_chars", F.length("text").cast("long"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences of at most 4096 tokens: a row for each piece of a document, with its ids (little-endian
    32-bit numbers) and its place.

    Only the lengths take part in the search; the ids are joined to the places found. A null or empty text is its
    end id alone; repeated rows and ids have pieces of their own; an empty table gives none; only the id and
    the text are read."""
    cut = stored(packing.pieces(docs, vocabulary_path("word_bpe_49k.json"))
                 .withColumn("piece_no", F.monotonically_increasing_id()), "pieces")
    placed = packing.pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.join(cut.select("piece_no", "ids"), "piece_no").drop("piece_no")


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: Near-duplicate search and packing cannot be expressed in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
        if before is not None:
            discard(before)
        before = docs
    return docs
