"""Corpus pipeline: drop toxic documents, keep one of each near-copy group, redact, mix, encode.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` writes as Parquet
under the checkpoint folder and rereads as the next stage's documents. All stages but the
last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paygrid.llm import byte_bpe, mixing, ngram_join, pii, toxicity
from paygrid.session import materialize, release_scratch, scratch_mark


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not predict as toxic."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group linked by 5-word shingles at a Jaccard of 0.8 or more."""
    return ngram_join.keep_one(docs, n=5, percent=80)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind in brackets."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids``: token ids of every document."""
    import public_tokenizers

    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("pii", redact_pii),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

# The fitted stages have no SQL form; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    start = scratch_mark()
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        # Written as a whole: the stage's working folders and its input are not read again.
        release_scratch(spark, start, keep_last=True)
    return docs
