"""Registered queries of the corpus operators: thin digests of the operators' outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, centroid_native, chat_pairs, decontam, fim_arrow, html_main, lm_attention, minhash_hamming, pstable_cosine, quality_llr,
               token_counts, token_files, warc_derivatives)
from .common import scratch, table, whole_text
from .oracle_sql import SQL  # noqa: F401  (read by the entry module)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_main.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference pairs of every conversation: the shared prompt once, both completions and their masks."""
    def mask(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat(s["start"].cast("string"), F.lit("+"), s["length"].cast("string"))), ",")

    pairs = chat_pairs.format_pairs(chat_pairs.reply_pairs(table(spark, sf_dir, "conversations")))
    return pairs.select("conv_id", "n_common", "prompt", "chosen_text", "rejected_text",
                        mask("chosen_spans").alias("chosen_mask"), mask("rejected_spans").alias("rejected_mask"))


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page's response record, as ids, links and digests."""
    made = warc_derivatives.derive(warc_derivatives.responses(table(spark, sf_dir, "pages")))
    return made.select("page_id", "error", "response_id", "target_uri", "payload_digest", "metadata_id", "conversion_id", "n_links",
                       F.char_length("text").cast("long").alias("n_chars"), F.sha2("metadata", 256).alias("metadata_sha256"),
                       F.sha2("conversion", 256).alias("conversion_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base quality counts and the likelihood-ratio verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_llr.fit(docs, table(spark, sf_dir, "labels"))
    return quality_llr.assess(docs, model).select("doc_id", "quality.*")


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document (four-word shingles, Jaccard 0.8 or more)."""
    found = minhash_hamming.groups(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in an occurrence of a benchmark window, and the items hit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "found.n_words", decontam.n_hit().alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
                        (F.size("found.spans") > 0).alias("contaminated"))


def op2_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and the bytes decoded from them, as digests."""
    return byte_bpe.digest(byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document against a context limit of 4096 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count(docs).select("doc_id", F.octet_length(whole_text()).cast("long").alias("n_bytes"), "n_tokens",
                                           (F.col("n_tokens") > 4096).alias("over_limit"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under the attention model and under the word unigram base."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(7))
    return lm_attention.score(docs, fold != 2)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, written in doc_id order and read back."""
    path = scratch(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component and number of links of every embedding (cosine 0.98 or more within a label)."""
    found = pstable_cosine.groups(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    return found.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op12_fim_transformation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of every document, and the text rebuilt from it, as digests."""
    made = fim_arrow.transform(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return fim_arrow.restore(made).select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
                                          F.sha2(F.col("fim.output").cast("binary"), 256).alias("output_sha256"),
                                          F.sha2(F.col("text").cast("binary"), 256).alias("restored_sha256"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every embedding after ten rounds from eight hashed starts."""
    found = centroid_native.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=8, dim=64, rounds=10, seed=3)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroid_native.centroid_digest().alias("centroid_sha256"))


REGISTRY = {f.__name__: f for f in (
    op1_html_extraction, op2_byte_level_bpe, op3_chat_formatting, op4_token_counts, op5_warc_derivatives,
    op6_lm_scoring, op7_token_files, op8_quality_rules, op9_benchmark_decontamination, op10_minhash_near_dedup,
    op11_embedding_near_dedup, op12_fim_transformation, op13_centroid_clustering)}
