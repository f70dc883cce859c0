"""Cross-script token alignment: IBM model 1 over linked names, as iterated DataFrame aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text

NULL, NULL_PRIOR = "", 0.1
ROUNDS, CONFIDENCE, MARGIN, SUPPORT = 8, 0.6, 0.2, 3
FEATURES = ("exact", "edit", "jaro", "ratio", "partial", "token_set", "token_sort", "jaccard", "containment", "left_coverage", "right_coverage", "right_nonlatin_fraction")


def _tokens(c):
    return text.tokens(text.legal_name(text.normalize_text(c)))


def sentences(pairs: DataFrame) -> DataFrame:
    """group_id, english, foreign (sorted distinct token arrays), weight. pairs: left_name, right_name, group_id."""
    latin = lambda t: t.rlike(r"\p{IsLatin}") & ~text.nonlatin(t) & t.rlike(r"^[\p{L}\p{M}]+$")
    s = pairs.select("group_id", F.array_sort(F.array_distinct(F.filter(_tokens(F.col("left_name")), latin))).alias("english"), F.array_sort(F.array_distinct(F.filter(_tokens(F.col("right_name")), text.nonlatin))).alias("foreign"))
    s = s.where((F.size("english") > 0) & (F.size("foreign") > 0)).dropDuplicates()
    return s.withColumn("weight", 1.0 / F.count("*").over(Window.partitionBy("group_id")))


def cells(found: DataFrame) -> DataFrame:
    """sid, group_id, weight, f, e, prior: each foreign token of a sentence with each English one and NULL. The product is inside one name."""
    s = found.withColumn("sid", F.sha2(F.concat_ws("\t", "group_id", F.array_join("english", " "), F.array_join("foreign", " ")), 256))
    return s.select("sid", "group_id", "weight", F.explode("foreign").alias("f"), F.concat("english", F.array(F.lit(NULL))).alias("es")).select("sid", "group_id", "weight", "f", F.explode("es").alias("e")).withColumn("prior", F.when(F.col("e") == NULL, NULL_PRIOR).otherwise(1.0))


def align(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """e, f, p (the probability of f given e), c (expected count). Lineage is cut each round by checkpoint()."""
    c = cells(found)
    start = c.select("e", "f").distinct()
    p = start.withColumn("p", 1.0 / F.count("*").over(Window.partitionBy("e"))).withColumn("c", F.lit(0.0))
    reliable = found.sparkSession.sparkContext.getCheckpointDir() is not None
    for _ in range(rounds):
        x = c.join(p.select("e", "f", "p"), ["e", "f"]).withColumn("x", F.col("prior") * F.col("p"))
        share = F.col("x") / F.sum("x").over(Window.partitionBy("sid", "f"))
        n = x.withColumn("n", F.col("weight") * share).groupBy("e", "f").agg(F.sum("n").alias("c"))
        p = n.withColumn("p", F.col("c") / F.sum("c").over(Window.partitionBy("e")))
        if reliable:
            p = p.checkpoint()
    return p


def lexicon(found: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, margin: float = MARGIN, support: int = SUPPORT) -> DataFrame:
    """foreign, english, confidence, margin, support, accepted: the best English token of each foreign one."""
    p = align(found, rounds)
    post = p.withColumn("q", F.col("c") / F.sum("c").over(Window.partitionBy("f")))
    best = Window.partitionBy("f").orderBy(F.desc("q"), F.desc("e"))
    top = post.withColumn("k", F.row_number().over(best)).withColumn("second", F.coalesce(F.lead("q").over(best), F.lit(0.0))).where("k = 1")
    seen = cells(found).groupBy("f", "e").agg(F.count_distinct("group_id").alias("support"))
    out = top.join(seen, ["f", "e"]).select(F.col("f").alias("foreign"), F.col("e").alias("english"), F.col("q").alias("confidence"), (F.col("q") - F.col("second")).alias("margin"), "support")
    return out.withColumn("accepted", (F.col("english") != NULL) & (F.col("confidence") >= confidence) & (F.col("margin") >= margin) & (F.col("support") >= support))


def translate(names: DataFrame, found: DataFrame) -> DataFrame:
    """names (id, name) with `translated`: tokens of the accepted lexicon replaced, the others kept. A join on tokens, so the lexicon may be of any size."""
    t = names.select("id", F.posexplode(_tokens(F.col("name"))).alias("at", "token"))
    own = found.where("accepted").select(F.col("foreign").alias("token"), "english")
    words = t.join(own, "token", "left").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("english", "token").alias("w")))).alias("ws"))
    return names.join(words, "id", "left").withColumn("translated", F.coalesce(F.array_join(F.transform("ws", lambda x: x["w"]), " "), F.lit(""))).drop("ws")


def features(pairs: DataFrame) -> DataFrame:
    """pairs (left, right, right_original: normalised texts; right is translated) with translated_name_* columns."""
    a, b = F.col("left"), F.col("right")
    x, y = F.array_distinct(text.tokens(a)), F.array_distinct(text.tokens(b))
    original = text.tokens(F.col("right_original"))
    part = lambda n, s: F.when(F.size(s) == 0, 0.0).otherwise(n / F.size(s))
    every = {"exact": sim.equal(a, b), "edit": sim.edit_similarity(a, b), "jaro": sim.jaro(a, b), "ratio": sim.indel(a, b), "partial": sim.partial(a, b), "token_set": sim.token_set(a, b), "token_sort": sim.token_sort(a, b), "jaccard": sim.jaccard(x, y), "containment": sim.containment(x, y), "left_coverage": part(sim.overlap(x, y), x), "right_coverage": part(sim.overlap(x, y), y), "right_nonlatin_fraction": part(F.size(F.filter(original, text.nonlatin)), original)}
    return pairs.select("*", *[every[f].cast("double").alias(f"translated_name_{f}") for f in FEATURES])
