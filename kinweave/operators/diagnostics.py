"""Reports on pairs, errors and retrievals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text

#: Percentiles and edges of score bins.
QUANTILES = (0, 1, 5, 10, 25, 50, 75, 90, 95, 99, 100)
SCORE_EDGES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.00001)


def categories(pairs: DataFrame) -> DataFrame:
    """category, n over pairs of prepared records left and right (structs of prepare())."""
    a, b, n = F.col("left"), F.col("right"), "normalized"
    name = sim.edit_similarity(a["name"][n], b["name"][n])
    address = sim.edit_similarity(a["address"][n], b["address"][n])
    flags: dict[str, Column] = {"all": F.lit(True)}
    for f, raw in (("name", "business_name"), ("address", "business_address")):
        x, y = a[f], b[f]
        flags |= {f"{f}_raw_exact": (a[raw] != "") & (a[raw] == b[raw]), f"{f}_normalized_exact": sim.equal(x[n], y[n]) == 1, f"{f}_folded_exact": sim.equal(x["folded"], y["folded"]) == 1, f"{f}_non_ascii": ~text.is_ascii(a[raw]) | ~text.is_ascii(b[raw]), f"{f}_missing": (x[n] == "") | (y[n] == ""), f"{f}_no_shared_tokens": (x[n] != "") & (y[n] != "") & (sim.overlap(x["tokens"], y["tokens"]) == 0), f"{f}_script_disjoint": (F.size(text.scripts(x[n])) > 0) & (F.size(text.scripts(y[n])) > 0) & ~F.arrays_overlap(text.scripts(x[n]), text.scripts(y[n])), f"{f}_numbers_conflict": sim.numbers(x["numbers"], y["numbers"])["conflict"] == 1}
    flags |= {"name_legal_exact": sim.equal(a["name"]["legal"], b["name"]["legal"]) == 1, "name_core_exact": sim.equal(a["name"]["core"], b["name"]["core"]) == 1, "country_conflict": (a["country_key"] != "") & (b["country_key"] != "") & (a["country_key"] != b["country_key"]), "name_edit_low": name < 0.3, "address_edit_low": address < 0.3, "low_name_strong_address": (name < 0.3) & (address > 0.7)}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("category"), v.alias("hit")) for k, v in flags.items()]))
    return pairs.select(each.alias("x")).groupBy("x.category").agg(F.count_if("x.hit").alias("n"))


def quantiles(df: DataFrame, col: str) -> DataFrame:
    """One row: mean and the quantiles, exact, by linear interpolation."""
    p = df.agg(F.avg(col).alias("mean"), F.percentile(col, F.array(*[F.lit(q / 100) for q in QUANTILES])).alias("q"))
    return p.select("mean", *[F.col("q")[i].alias(f"p{q}") for i, q in enumerate(QUANTILES)])


def hardest(pairs: DataFrame, name_edit: str, address_edit: str, limit: int = 50) -> DataFrame:
    h = 1 - (0.6 * F.col(name_edit) + 0.4 * F.col(address_edit))
    return pairs.withColumn("hardness", h).orderBy(F.desc("hardness"), "s1_id", "target_id").limit(limit)


def error_groups(entities: DataFrame) -> DataFrame:
    """entities: s1_id, country, non_ascii, n_true, tp, predicted, f05, retrieved. One row a group: overall, by country, singletons, several links, non-ASCII."""
    groups = F.array_compact(F.array(F.lit("overall"), F.concat(F.lit("country:"), "country"), F.when(F.col("n_true") == 0, "singleton"), F.when(F.col("n_true") > 1, "multiple"), F.when(F.col("non_ascii"), "non_ascii")))
    return entities.withColumn("group", F.explode(groups)).groupBy("group").agg(F.count("*").alias("entities"), F.avg("f05").alias("macro_f0_5"), F.sum(F.col("predicted") - F.col("tp")).alias("fp"), F.sum(F.col("n_true") - F.col("tp")).alias("fn"), F.sum(F.col("n_true") - F.col("retrieved")).alias("unretrieved"))


def worst(entities: DataFrame, limit: int = 50) -> DataFrame:
    return entities.orderBy("f05", "s1_id").limit(limit)


def bootstrap(entities: DataFrame, replicates: int = 400, seed: str = "42") -> DataFrame:
    """low, high: 2.5 and 97.5 percent of the mean F0.5 over resamples. Each entity is drawn a Poisson number of times, by a hash of replicate and id, so no sample is collected and partial sums combine early."""
    u = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("r").cast("string"), F.lit(":"), F.col("s1_id"))), 1, 8), 16, 10).cast("double") / 2.0**32
    steps, p, total = F.lit(0), 0.36787944117144233, 0.0
    for k in range(12):
        total += p
        steps = F.when(u >= total, k + 1).otherwise(steps)
        p /= k + 1
    drawn = entities.withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("k", steps)
    means = drawn.groupBy("r").agg((F.sum(F.col("k") * F.col("f05")) / F.sum("k")).alias("m"))
    return means.agg(F.percentile("m", F.lit(0.025)).alias("low"), F.percentile("m", F.lit(0.975)).alias("high"))


def strata(pairs: DataFrame, masks: dict[str, Column], threshold: float) -> DataFrame:
    """The confusion of each of several overlapping groups of pairs."""
    each = F.explode(F.filter(F.array(*[F.struct(F.lit(k).alias("name"), v.alias("hit")) for k, v in masks.items()]), lambda x: x["hit"]))
    yes, true = F.col("score") >= threshold, F.col("label") == 1
    n = pairs.select("score", "label", each.alias("x")).groupBy(F.col("x.name").alias("stratum")).agg(F.count("*").alias("candidate_pairs"), F.count_if(yes & true).alias("tp"), F.count_if(yes & ~true).alias("fp"), F.count_if(~yes & true).alias("retrieved_fn"), F.count_if(~yes & ~true).alias("tn"))
    return n.select("*", F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"), F.try_divide("tp", F.col("tp") + F.col("retrieved_fn")).alias("recall"))


def bins(pairs: DataFrame, col: str, edges: tuple[float, ...] = SCORE_EDGES) -> DataFrame:
    """Half-open bins with their pairs and positives."""
    b = F.lit(None).cast("int")
    for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        b = F.when((F.col(col) >= lo) & (F.col(col) < hi), i).otherwise(b)
    return pairs.withColumn("bin", b).where("bin is not null").groupBy("bin").agg(F.count("*").alias("pairs"), F.sum("label").alias("positives"))


def examples(pairs: DataFrame, threshold: float, limit: int = 30) -> DataFrame:
    """The false positives of highest score and the retrieved false negatives of lowest, with their kind."""
    fp = pairs.where((F.col("score") >= threshold) & (F.col("label") == 0)).orderBy(F.desc("score"), "s1_id", "target_code").limit(limit).withColumn("kind", F.lit("fp"))
    fn = pairs.where((F.col("score") < threshold) & (F.col("label") == 1)).orderBy("score", "s1_id", "target_code").limit(limit).withColumn("kind", F.lit("fn"))
    return fp.unionByName(fn)


def retrieval_diff(truth: DataFrame, base: DataFrame, other: DataFrame) -> DataFrame:
    """True links that only one of two candidate sets finds. All: query_id, target_code."""
    keys = ["query_id", "target_code"]
    a, b = truth.join(base.select(*keys), keys, "left_semi").select(*keys), truth.join(other.select(*keys), keys, "left_semi").select(*keys)
    return a.exceptAll(b).withColumn("change", F.lit("lost")).unionByName(b.exceptAll(a).withColumn("change", F.lit("gained")))


def margin(pairs: DataFrame) -> DataFrame:
    """pairs with the distance of each score to the best other score of its anchor."""
    w = Window.partitionBy("s1_id").orderBy(F.desc("score"), "target_code")
    top2 = pairs.withColumn("_k", F.row_number().over(w)).where("_k <= 2").groupBy("s1_id").agg(F.max(F.when(F.col("_k") == 1, F.col("score"))).alias("_a"), F.max(F.when(F.col("_k") == 1, F.col("target_code"))).alias("_c"), F.max(F.when(F.col("_k") == 2, F.col("score"))).alias("_b"))
    return pairs.join(top2, "s1_id").withColumn("margin", F.col("score") - F.coalesce(F.when(F.col("target_code") == F.col("_c"), F.col("_b")).otherwise(F.col("_a")), F.lit(0.0))).drop("_a", "_b", "_c")
