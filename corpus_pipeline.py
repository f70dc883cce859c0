"""The corpus pipeline: quality rules, near duplicates, benchmark decontamination, PII and byte-level BPE, in this order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinweave.llm import bpe, decontam, ngram_join, pii, quality
from kinweave.llm.common import materialize, table
from kinweave.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; boilerplate lines of the others go from their text."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents (similarity of five-word shingles 0.8 or more) the one with the smallest doc_id stays."""
    return ngram_join.one_of_each(docs, percent=80, size=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts become surrogates."""
    return pii.clean(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, ids, n_tokens, and n_bytes, the bytes that the ids decode to; ids that decode to anything but the text raise."""
    return bpe.encode(docs, vocabulary(spark))


STAGES = [("quality_rules", quality_rules), ("ngram_jaccard_join", near_duplicates), ("benchmark_decontamination", decontamination), ("pii", pii_surrogates), ("byte_bpe", byte_bpe)]

#: The stages have no SQL as a whole; tests/llm hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
