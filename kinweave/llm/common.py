"""Helpers that the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.steps import delete_path, discard, fresh_path, materialize, shared_dir  # noqa: F401

#: White space that separates words: \x20 and \x09-\x0D, as a Java class.
SPACE = r"[ \t-\r]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Maximal runs of anything but white space; null and blank texts give an empty array."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"{SPACE}+"))


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once a row even where lambdas inside body refer to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def oracle_key(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))
