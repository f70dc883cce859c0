"""The thin queries over the operators and their SQL, for the driver's entry file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontam, htmltext, licenses, ngram_join, pii, quality, suffix_dedup, urlfilter, warc
from .common import table

#: The vocabulary that op1 and the pipeline encode by.
RANKS = "byte_bpe_multi_50k.tiktoken"


def vocabulary(spark: SparkSession, ranks: str = RANKS) -> bpe.Vocabulary:
    import public_tokenizers

    return bpe.Vocabulary(spark, public_tokenizers.path(ranks), public_tokenizers.PATTERN)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary(spark))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.templates(spark))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scrub(table(spark, sf_dir, "documents"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).drop("kept")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_warc, op3_benchmark_decontamination, op4_license_scans, op5_html_extraction, op6_ngram_jaccard_join, op7_pii, op8_url_filters, op9_suffix_array_dedup, op10_quality_rules)}

ORACLES = {"op2_warc": warc.ORACLE, "op4_license_scans": licenses.oracle(), "op6_ngram_jaccard_join": ngram_join.ORACLE, "op8_url_filters": urlfilter.oracle(), "op9_suffix_array_dedup": suffix_dedup.ORACLE, "op10_quality_rules": quality.ORACLE}
