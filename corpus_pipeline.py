"""Corpus pipeline: quality rules, near-duplicate removal, decontamination, tokenisation.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir), where ``docs`` is what
its predecessor kept, and returns a DataFrame.  ``run`` writes each stage's result as Parquet in the
shared checkpoint folder and rereads it as the next one's input.  The learned threshold of the first
stage, MinHash and BPE have no SQL form, so ``ORACLE_SQL`` is None; the tests hold ``run`` against a
brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storemart.llm import byte_bpe, decontam, minhash_hamming, quality_llr
from storemart.llm.common import materialise, table
from storemart.session import configure

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood-ratio threshold."""
    configure(spark)
    return quality_llr.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8 or more)."""
    configure(spark)
    return minhash_hamming.keep_one(docs, shingle=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    configure(spark)
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with the digests of ids and decoded bytes."""
    configure(spark)
    return byte_bpe.digest(byte_bpe.encode(docs.select("doc_id", "text")), keep_ids=True)


STAGES = [("quality rules", quality), ("near-duplicate removal", near_duplicates),
          ("benchmark decontamination", decontaminate), ("byte-level BPE", tokenise)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
