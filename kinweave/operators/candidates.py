"""Exact blocking joins, the candidate union, labels, and recall."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bits of the provenance mask, in the order in which branches claim a hit.
#: The bit of each branch in a mask.
BITS = {"name_char": 1, "name_word": 2, "address_char": 4, "name_exact": 8, "number_block": 16}
SPARSE = ("name_char", "name_word", "address_char")


def name_exact(queries: DataFrame, targets: DataFrame) -> DataFrame:
    """query_id, target_code of equal names. Both sides: entity_id, name_key, address_key; targets: code."""
    q = queries.where("name_key <> ''").select(F.col("entity_id").alias("query_id"), "name_key")
    return q.join(targets.select("name_key", F.col("code").alias("target_code")), "name_key").select("query_id", "target_code")


def number_block(queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Equal whole addresses, where the query's has a digit."""
    q = queries.where(F.col("address_key").rlike(r"\p{Nd}")).select(F.col("entity_id").alias("query_id"), "address_key")
    return q.join(targets.select("address_key", F.col("code").alias("target_code")), "address_key").select("query_id", "target_code")


def smallest(targets: DataFrame, key: str, cap: int) -> DataFrame:
    """Of each key the targets with its `cap` smallest codes."""
    first = Window.partitionBy(key).orderBy("code")
    return targets.select(key, "code").withColumn("_k", F.dense_rank().over(first)).where(F.col("_k") <= cap).drop("_k")


def exact(queries: DataFrame, targets: DataFrame, cap: int | None = None) -> DataFrame:
    """query_id, target_code, mask of both exact joins. With cap, of each join those that can be among a query's `cap` smallest codes, so that n equal names on both sides give n * cap rows and not n^2; for capped() of that cap or less the result is the same."""
    tag = lambda df, b: df.withColumn("mask", F.lit(BITS[b]))
    by = lambda key: targets if cap is None else smallest(targets, key, cap)
    both = tag(name_exact(queries, by("name_key")), "name_exact").unionByName(tag(number_block(queries, by("address_key")), "number_block"))
    return both.groupBy("query_id", "target_code").agg(F.bit_or("mask").alias("mask"))


def exact_among(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """exact() without a cap, of the given pairs (query_id, target_code) only. Each pair's keys are looked up, so that n equal names on both sides are no more rows than there are pairs."""
    keys = lambda df, i, side: df.select(F.col(i).alias(side), F.struct("name_key", "address_key").alias(f"_{side}"))
    p = pairs.select("query_id", "target_code").distinct().join(keys(queries, "entity_id", "query_id"), "query_id").join(keys(targets, "code", "target_code"), "target_code")
    q, t = F.col("_query_id"), F.col("_target_code")
    name, address = (q["name_key"] == t["name_key"]) & (q["name_key"] != ""), (q["address_key"] == t["address_key"]) & q["address_key"].rlike(r"\p{Nd}")
    mask = F.when(name, BITS["name_exact"]).otherwise(0) + F.when(address, BITS["number_block"]).otherwise(0)
    return p.withColumn("mask", mask).where("mask <> 0").groupBy("query_id", "target_code").agg(F.bit_or("mask").alias("mask"))


def capped(pairs: DataFrame, cap: int = 200) -> DataFrame:
    """Each query's `cap` smallest codes: source 2 before source 3."""
    return pairs.withColumn("_k", F.row_number().over(Window.partitionBy("query_id").orderBy("target_code"))).where(F.col("_k") <= cap).drop("_k")


def overflow(pairs: DataFrame, cap: int = 200) -> DataFrame:
    n = pairs.groupBy("query_id").agg(F.count("*").alias("n"))
    return n.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("eligible"), F.coalesce(F.sum(F.least("n", F.lit(cap))), F.lit(0)).alias("retained"), F.coalesce(F.sum(F.greatest(F.col("n") - cap, F.lit(0))), F.lit(0)).alias("discarded"), F.count_if(F.col("n") > cap).alias("overflow_queries"))


def union(sparse: dict[str, DataFrame], exact_pairs: DataFrame) -> DataFrame:
    """One row for each (query_id, target_code): mask, and score_* and rank_* of each sparse branch (0 where it has none). sparse: query_id, target_code, score, rank."""
    zero = lambda t: F.lit(0).cast(t)
    rows = [df.select("query_id", "target_code", F.lit(BITS[b]).alias("mask"), *[(F.col("score") if b == c else zero("long")).alias(f"score_{c}") for c in SPARSE], *[(F.col("rank") if b == c else zero("int")).alias(f"rank_{c}") for c in SPARSE]) for b, df in sparse.items()]
    rows.append(exact_pairs.select("query_id", "target_code", "mask", *[zero("long").alias(f"score_{c}") for c in SPARSE], *[zero("int").alias(f"rank_{c}") for c in SPARSE]))
    every = reduce(DataFrame.unionByName, rows)
    return every.groupBy("query_id", "target_code").agg(F.bit_or("mask").alias("mask"), *[F.max(f"{x}_{c}").alias(f"{x}_{c}") for x in ("score", "rank") for c in SPARSE])


def check(candidates: DataFrame, anchors: DataFrame, targets: DataFrame) -> None:
    """Raises on null or repeated pairs, and on ids that aren't in anchors (entity_id) or targets (target_code)."""
    bad = {
        "a pair has a null id": candidates.where("query_id is null or target_code is null"),
        "a pair occurs twice": candidates.groupBy("query_id", "target_code").count().where("count > 1"),
        "an anchor is unknown": candidates.join(anchors.select(F.col("entity_id").alias("query_id")), "query_id", "left_anti"),
        "a target is unknown": candidates.join(targets.select("target_code"), "target_code", "left_anti"),
    }
    for what, rows in bad.items():
        if not rows.isEmpty():
            raise ValueError(what)


def label(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """candidates with label. truth: s1_id, target_code."""
    t = truth.select(F.col("s1_id").alias("query_id"), "target_code", F.lit(1).alias("_t"))
    return candidates.join(t, ["query_id", "target_code"], "left").withColumn("label", F.coalesce("_t", F.lit(0))).drop("_t")


def counts(anchors: DataFrame, candidates: DataFrame) -> DataFrame:
    """Distribution of candidates an anchor, those without any included; percentiles by linear interpolation."""
    n = anchors.select(F.col("entity_id").alias("query_id")).join(candidates.groupBy("query_id").agg(F.count("*").alias("n")), "query_id", "left").na.fill(0, ["n"])
    return n.agg(F.avg("n").alias("mean"), F.max("n").alias("max"), *[F.percentile("n", F.lit(p / 100)).alias(f"p{p}") for p in (50, 90, 95, 99)])


def by_branch(candidates: DataFrame) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(b).alias("branch"), (F.col("mask").bitwiseAND(bit) != 0).alias("hit")) for b, bit in BITS.items()]))
    return candidates.select(each.alias("x")).groupBy("x.branch").agg(F.count_if("x.hit").alias("pairs"))


def found(anchors: DataFrame, truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """query_id, country, n_true, n_found of each anchor."""
    t = truth.select(F.col("s1_id").alias("query_id"), "target_code")
    hit = t.join(candidates.select("query_id", "target_code", F.lit(1).alias("hit")), ["query_id", "target_code"], "left")
    n = hit.groupBy("query_id").agg(F.count("*").alias("n_true"), F.count("hit").alias("n_found"))
    return anchors.select(F.col("entity_id").alias("query_id"), "country").join(n, "query_id", "left").na.fill(0, ["n_true", "n_found"])


def bucket(n):
    return F.when(n == 0, "0").when(n == 1, "1").when(n <= 3, "2-3").when(n <= 6, "4-6").otherwise("7+")


def recall(per_anchor: DataFrame, *by: str) -> DataFrame:
    """Links, recall of links, mean recall of anchors with links, and the ceiling of entity F0.5 that a perfect classifier reaches."""
    ceiling = F.when(F.col("n_true") == 0, 1.0).otherwise(1.25 * F.col("n_found") / (F.col("n_found") + 0.25 * F.col("n_true")))
    agg = [F.count("*").alias("anchors"), F.sum("n_true").alias("links"), F.sum("n_found").alias("found"), F.try_divide(F.sum("n_found"), F.sum("n_true")).alias("link_recall"), F.avg(F.when(F.col("n_true") > 0, F.col("n_found") / F.col("n_true"))).alias("macro_recall"), F.avg(ceiling).alias("f05_ceiling")]
    return per_anchor.groupBy(*by).agg(*agg) if by else per_anchor.agg(*agg)


def recall_by_source(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    t = truth.select(F.col("s1_id").alias("query_id"), "target_code")
    hit = t.join(candidates.select("query_id", "target_code", F.lit(1).alias("hit")), ["query_id", "target_code"], "left")
    return hit.groupBy(F.floor(F.col("target_code") / 10**12).cast("int").alias("source")).agg(F.count("*").alias("links"), F.count("hit").alias("found"))


def branch_recall(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """For each branch: links it finds alone, links it is the first to find, and the running sum of those."""
    t = truth.select(F.col("s1_id").alias("query_id"), "target_code")
    hit = t.join(candidates.select("query_id", "target_code", "mask"), ["query_id", "target_code"], "left").na.fill(0, ["mask"])
    first = lambda bit: F.col("mask").bitwiseAND(2 * bit - 1) == bit  # the lowest bit that is set
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("branch_no"), F.lit(b).alias("branch"), (F.col("mask").bitwiseAND(bit) != 0).alias("alone"), first(bit).alias("first")) for i, (b, bit) in enumerate(BITS.items())]))
    n = hit.select(each.alias("x")).groupBy("x.branch_no", "x.branch").agg(F.count("*").alias("links"), F.count_if("x.alone").alias("standalone"), F.count_if("x.first").alias("incremental"))
    return n.withColumn("cumulative", F.sum("incremental").over(Window.orderBy("branch_no").rowsBetween(Window.unboundedPreceding, 0)))  # five rows
