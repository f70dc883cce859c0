"""Graph consistency: what the trusted candidates of an anchor say about each of its candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import features

TRUSTED, KEPT, USED = 0.95, 4, 3
#: The roles of a score, and names of columns in contractual order.
ROLES = ("out_of_fold_train", "frozen_calibration", "frozen_validation", "frozen_inference")
CONTEXT = ("candidate_score", "support_count", "source2_support_count", "source3_support_count", "support_source_diversity", "same_source_support_count", "cross_source_support_count", "max_support_score", "mean_support_score", "score_margin")
COMPARED = (*features.ADVANCED[:38], *(f"{f}_{x}" for f in ("name", "address") for x in ("exact", "folded_exact", "token_jaccard", "token_containment", "edit_similarity", "numbers_equal", "numbers_overlap", "numbers_jaccard")), "country_equal")
NAMES = (*(f"graph_{c}" for c in CONTEXT), *(f"graph_support_max_{c}" for c in COMPARED))


def supports(scored: DataFrame) -> DataFrame:
    """The best KEPT candidates of each anchor from TRUSTED on. scored: query_id, target_code, score."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "target_code")
    return scored.where(F.col("score") >= TRUSTED).withColumn("k", F.row_number().over(best)).where(F.col("k") <= KEPT).select("query_id", F.col("target_code").alias("support"), F.col("score").alias("support_score"), "k")


def supported(scored: DataFrame) -> DataFrame:
    """Each candidate with its supports: the first USED trusted ones but for itself."""
    s = scored.select("query_id", "target_code", "score").join(supports(scored), "query_id", "left")
    s = s.withColumn("ok", F.coalesce(F.col("support") != F.col("target_code"), F.lit(False)))
    rank = F.sum(F.col("ok").cast("int")).over(Window.partitionBy("query_id", "target_code").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    return s.withColumn("ok", F.col("ok") & (rank <= USED))


def context(scored: DataFrame) -> DataFrame:
    """query_id, target_code and CONTEXT; all but the score are 0 without support."""
    source = lambda c: F.floor(F.col(c) / 10**12)
    of = lambda c: F.when(F.col("ok"), c)
    n = lambda c: F.count_if(F.col("ok") & c).cast("long")
    same = source("support") == source("target_code")
    s = supported(scored).groupBy("query_id", "target_code").agg(
        F.first("score").alias("candidate_score"), n(F.lit(True)).alias("support_count"), n(source("support") == 2).alias("source2_support_count"), n(source("support") == 3).alias("source3_support_count"),
        F.count_distinct(of(source("support"))).alias("support_source_diversity"), n(same).alias("same_source_support_count"), n(~same).alias("cross_source_support_count"),
        F.coalesce(F.max(of(F.col("support_score"))), F.lit(0.0)).alias("max_support_score"), F.coalesce(F.avg(of(F.col("support_score"))), F.lit(0.0)).alias("mean_support_score"),
    )
    return s.withColumn("score_margin", F.when(F.col("support_count") == 0, 0.0).otherwise(F.col("candidate_score") - F.col("max_support_score")))


def comparisons(scored: DataFrame, targets: DataFrame) -> DataFrame:
    """query_id, target_code and, for each of COMPARED, the largest value between the candidate and a support, at least 0. targets: prepared."""
    of = supported(scored).where("ok").groupBy("query_id", "target_code").agg(F.array_sort(F.collect_list("support")).alias("supports"))
    s = scored.select("query_id", "target_code").join(of, ["query_id", "target_code"], "left")
    # anchors share targets and supports: each two targets are compared once, each target with its supports is one group
    group = s.where("supports is not null").select("target_code", "supports").distinct()
    member = group.select("*", F.explode("supports").alias("support"))
    t, v = targets.select("code", F.struct(*targets.columns).alias("r")), features.views(targets)
    p = member.select("target_code", "support").distinct().join(t.select(F.col("code").alias("target_code"), F.col("r").alias("left")), "target_code").join(t.select(F.col("code").alias("support"), F.col("r").alias("right")), "support")
    p = features.with_views(p, v, v, ("target_code", "support"), ("code", "code"))
    every = features.record_features(F.col("left"), F.col("right")) | features.view_columns()
    each = p.select("target_code", "support", *[every[c].cast("double").alias(c) for c in COMPARED])
    best = member.join(each, ["target_code", "support"]).groupBy("target_code", "supports").agg(*[F.greatest(F.max(c), F.lit(0.0)).alias(f"graph_support_max_{c}") for c in COMPARED])
    return s.join(best, ["target_code", "supports"], "left").select("query_id", "target_code", *[f"graph_support_max_{c}" for c in COMPARED]).na.fill(0.0)


def build(scored: DataFrame, targets: DataFrame, role: str) -> DataFrame:
    """Context and comparisons. Scores must come from a model that hasn't seen the anchors' labels: role says how."""
    if role not in ROLES:
        raise ValueError(f"{role} is none of {ROLES}")
    if scored.where(~F.col("score").between(0, 1)).limit(1).collect() or scored.groupBy("query_id", "target_code").count().where("count > 1").limit(1).collect():
        raise ValueError("scores must be between 0 and 1, one for each pair")
    c = context(scored).select("query_id", "target_code", *[F.col(x).cast("double").alias(f"graph_{x}") for x in CONTEXT])
    return c.join(comparisons(scored, targets), ["query_id", "target_code"])
