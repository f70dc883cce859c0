"""Entity F0.5, threshold sweeps and the choice of a threshold.

pairs: s1_id, target_code, label, score. truth: s1_id, n_true, a row for each
anchor, singletons included. Unretrieved links count through n_true.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def f05(tp: Column, predicted: Column, true: Column) -> Column:
    """1 where nothing is true and nothing predicted."""
    return F.when((predicted == 0) & (true == 0), 1.0).otherwise(1.25 * tp / (predicted + 0.25 * true))


def check(pairs: DataFrame, truth: DataFrame) -> None:
    """Raises on repeated pairs, unknown anchors, scores that aren't finite, and more positives than true links."""
    bad = {
        "a pair occurs twice": pairs.groupBy("s1_id", "target_code").count().where("count > 1"),
        "an anchor occurs twice": truth.groupBy("s1_id").count().where("count > 1"),
        "an anchor is unknown": pairs.join(truth, "s1_id", "left_anti"),
        "a score isn't finite": pairs.where(F.col("score").isNull() | F.isnan("score") | (F.abs("score") == float("inf"))),
        "there are more positives than true links": pairs.groupBy("s1_id").agg(F.sum("label").alias("p")).join(truth, "s1_id").where("p > n_true"),
    }
    for what, rows in bad.items():
        if rows.limit(1).collect():
            raise ValueError(what)


def per_entity(pairs: DataFrame, truth: DataFrame, threshold: float) -> DataFrame:
    """s1_id, n_true, tp, predicted, f05 at score >= threshold."""
    n = pairs.where(F.col("score") >= threshold).groupBy("s1_id").agg(F.sum("label").alias("tp"), F.count("*").alias("predicted"))
    return truth.join(n, "s1_id", "left").na.fill(0, ["tp", "predicted"]).withColumn("f05", f05(F.col("tp"), F.col("predicted"), F.col("n_true")))


def summary(entities: DataFrame) -> DataFrame:
    """The 17 figures of a decision."""
    s = entities.agg(
        F.avg("f05").alias("macro_f0_5"), F.sum("tp").alias("tp"), F.sum(F.col("predicted") - F.col("tp")).alias("fp"), F.sum(F.col("n_true") - F.col("tp")).alias("fn"),
        F.sum("n_true").alias("true_links"), F.sum("predicted").alias("predicted_links"), F.count("*").alias("entities"), F.count_if(F.col("n_true") == 0).alias("singleton_count"),
        F.count_if((F.col("n_true") == 0) & (F.col("predicted") == 0)).alias("correct_singletons"), F.count_if((F.col("n_true") == 0) & (F.col("predicted") > 0)).alias("false_singleton_merges"),
    )
    part = lambda a, b: F.when(b == 0, 0.0).otherwise(a / b)
    c = F.col
    return s.select("*", part(c("tp"), c("predicted_links")).alias("micro_precision"), part(c("tp"), c("true_links")).alias("micro_recall"), part(1.25 * c("tp"), c("predicted_links") + 0.25 * c("true_links")).alias("micro_f0_5"), F.try_divide(c("correct_singletons"), c("singleton_count")).alias("singleton_accuracy"), part(c("predicted_links"), c("entities")).alias("predicted_per_entity"), part(c("true_links"), c("entities")).alias("true_per_entity"), part(c("fp"), c("entities")).alias("fp_per_entity"))


def _changes(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """For each anchor and distinct score: by how much the anchor's F0.5, tp and predictions change when the threshold comes down to it."""
    step = pairs.groupBy("s1_id", "score").agg(F.sum("label").alias("d_tp"), F.count("*").alias("d_pred"))
    down = Window.partitionBy("s1_id").orderBy(F.desc("score"))
    run = down.rowsBetween(Window.unboundedPreceding, 0)
    s = step.join(truth, "s1_id").select("*", F.sum("d_tp").over(run).alias("tp"), F.sum("d_pred").over(run).alias("pred"))
    now = f05(F.col("tp"), F.col("pred"), F.col("n_true"))
    before = f05(F.col("tp") - F.col("d_tp"), F.col("pred") - F.col("d_pred"), F.col("n_true"))
    return s.select("score", (now - before).alias("d_f"), "d_tp", "d_pred")


def sweep(pairs: DataFrame, truth: DataFrame, grid: list[float] | None = None) -> DataFrame:
    """threshold, macro_f0_5, tp, predicted, for each distinct score and +inf, or for the grid (thresholds are inclusive).

    Each pair enters once, as a change at its score; a running sum over levels
    gives the curve. Changes are summed by level (of the grid) first, so the sum
    is over levels, not pairs.
    """
    changes = _changes(pairs, truth)
    total, start = truth.agg(F.count("*").alias("n"), F.count_if(F.col("n_true") == 0).alias("f0")), [float("inf")]
    if grid is not None:
        levels = sorted(set(grid), reverse=True)
        spot = F.lit(None).cast("double")
        for g in sorted(levels):  # the largest level that the score reaches
            spot = F.when(F.col("score") >= g, g).otherwise(spot)
        changes, start = changes.withColumn("score", spot).where("score is not null"), levels
    spark = pairs.sparkSession
    zero = spark.createDataFrame([(float(x), 0.0, 0, 0) for x in start], "threshold double, d_f double, d_tp long, d_pred long")
    by_level = changes.groupBy(F.col("score").alias("threshold")).agg(F.sum("d_f").alias("d_f"), F.sum("d_tp").alias("d_tp"), F.sum("d_pred").alias("d_pred")).unionByName(zero).groupBy("threshold").agg(F.sum("d_f").alias("d_f"), F.sum("d_tp").alias("d_tp"), F.sum("d_pred").alias("d_pred"))
    run = Window.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    curve = by_level.select("threshold", F.sum("d_f").over(run).alias("f"), F.sum("d_tp").over(run).alias("tp"), F.sum("d_pred").over(run).alias("predicted"))
    return curve.crossJoin(F.broadcast(total)).select("threshold", ((F.col("f") + F.col("f0")) / F.col("n")).alias("macro_f0_5"), "tp", "predicted")


def select(curve: DataFrame) -> DataFrame:
    """The level of highest macro F0.5; of equals (to 12 places) the highest."""
    return curve.orderBy(F.desc(F.round("macro_f0_5", 12)), F.desc("threshold")).limit(1)


#: The first number above 1.
ABOVE_ONE = 1.0000000000000002


def decide(pairs: DataFrame, truth: DataFrame) -> dict:
    """The threshold: a coarse grid, then a fine one around its best level. Raises where check() does."""
    check(pairs, truth)
    coarse = [0.0, 1.0, ABOVE_ONE, *(round(0.05 + 0.01 * i, 2) for i in range(95))]
    best = select(sweep(pairs, truth, coarse)).first()
    around = [x for i in range(-20, 21) if 0 <= (x := round(best.threshold + 0.001 * i, 3)) <= 1]
    return select(sweep(pairs, truth, sorted({*around, best.threshold}))).first().asDict()
