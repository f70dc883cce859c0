"""Hash folds, splits and bottom-hash samples. SHA-256 is the hash: any engine can repeat it, whatever the order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^60; the first 15 hexadecimal digits of a digest are a number below it.
RANGE = 1 << 60


def hash_number(seed: str, key: Column) -> Column:
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key), 256), 1, 15), 16, 10).cast("long")


def fold(key: Column, seed: str = "42", fractions: tuple[float, float] = (0.8, 0.1)) -> Column:
    h, a, b = hash_number(seed, key), int(fractions[0] * RANGE), int(sum(fractions) * RANGE)
    return F.when(h < a, "train").when(h < b, "calibration").otherwise("validation")


def split(records: DataFrame, links: DataFrame, seed: str = "42", fractions: tuple[float, float] = (0.8, 0.1)) -> DataFrame:
    """records with split: anchors and unlinked targets by their own hash, linked targets with their owner."""
    owners = links.select(F.col("target_id").alias("entity_id"), fold(F.col("s1_id"), seed, fractions).alias("owner_split"))
    return records.join(owners, "entity_id", "left").withColumn("split", F.coalesce("owner_split", fold(F.col("entity_id"), seed, fractions))).drop("owner_split")


def check_split(split_records: DataFrame, links: DataFrame) -> None:
    """Raises where a linked pair lies in two folds or an entity occurs twice."""
    s = split_records.select("entity_id", "split")
    crossing = links.join(s.toDF("s1_id", "a"), "s1_id").join(s.toDF("target_id", "b"), "target_id").where("a <> b").limit(1).collect()
    if crossing:
        raise ValueError(f"{crossing[0]} crosses folds")
    if s.groupBy("entity_id").count().where("count > 1").limit(1).collect():
        raise ValueError("an entity occurs twice")


def split_stats(split_records: DataFrame, links: DataFrame) -> DataFrame:
    """Of each fold: anchors, links, singletons, rows by source, unlinked targets."""
    n = links.groupBy("s1_id").agg(F.count("*").alias("n_links"))
    linked = links.select(F.col("target_id").alias("entity_id"), F.lit(1).alias("linked"))
    all_rows = split_records.join(n, F.col("entity_id") == F.col("s1_id"), "left").join(linked, "entity_id", "left")
    count = lambda c: F.count_if(c).cast("long")
    return all_rows.groupBy("split").agg(
        count(F.col("source") == 1).alias("n_anchors"), F.sum(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), count((F.col("source") == 1) & F.col("n_links").isNull()).alias("n_singletons"),
        count(F.col("source") == 2).alias("n_source2"), count(F.col("source") == 3).alias("n_source3"), count((F.col("source") > 1) & F.col("linked").isNull()).alias("n_unlinked"),
    )


def bottom_hash(records: DataFrame, limit: int, seed: str = "42") -> DataFrame:
    """The `limit` rows of smallest hash: a uniform sample that doesn't depend on order; limit <= 0 keeps all."""
    if limit <= 0:
        return records
    return records.withColumn("_h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("entity_id")), 256)).orderBy("_h", "entity_id").limit(limit).drop("_h")


def out_of_fold(key: Column, folds: int = 3, seed: str = "graph-oof-42") -> Column:
    return (hash_number(seed, key) % folds).cast("int")


def refuse_held_out(name: str) -> None:
    """Fitting on anything but training data raises."""
    if any(w in name.lower() for w in ("test", "validation", "calibration", "holdout")):
        raise ValueError(f"{name} is held out")
