"""Competing references: how many other anchors bear the target's name, and whether one of them explains its address better."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text

KINDS = ("legal", "core")
PREFIX = {"legal": "reference_name", "core": "reference_core"}
MOST = 100
FIELDS = ("other_count_log", "overflow", "other_address_ratio", "other_address_token_set", "other_address_token_sort", "other_number_jaccard", "other_joint", "address_margin")
NAMES = tuple(f"{PREFIX[k]}_{f}" for k in KINDS for f in FIELDS)


def keys(prepared: DataFrame) -> DataFrame:
    """entity_id, code, country_key, legal, core (of the romanised name), address (romanised), numbers."""
    df = text.romanize(text.romanize(prepared.select("entity_id", "code", "country_key", F.col("name.normalized").alias("_n"), F.col("address.normalized").alias("_a")), "_n", "_r"), "_a", "_s")
    legal, view = text.legal_name(F.col("_r")), text.alternate_view(F.col("_s"))
    return df.select("entity_id", "code", "country_key", legal.alias("legal"), text.core_name(legal).alias("core"), view["text"].alias("address"), F.array_distinct(view["numbers"]).alias("numbers"))


def owners(anchors: DataFrame, kind: str) -> DataFrame:
    """key, n_owners and, for keys of up to MOST owners, their ids, countries, addresses and numbers (so the list is bounded)."""
    a = anchors.where(F.col(kind) != "").withColumn("key", F.col(kind))
    n = a.groupBy("key").agg(F.count("*").alias("n_owners"))
    few = a.join(n.where(F.col("n_owners") <= MOST), "key").groupBy("key").agg(F.collect_list(F.struct("entity_id", "country_key", "address", "numbers")).alias("owners"))
    return n.join(few, "key", "left")


def counts(pairs: DataFrame, anchors: DataFrame, targets: DataFrame) -> DataFrame:
    """query_id, target_code and, for each kind, the number of other owners of the target's key and whether there are too many. anchors, targets: keys()."""
    out = pairs.select("query_id", "target_code").join(targets.select(F.col("code").alias("target_code"), *KINDS), "target_code")
    for kind in KINDS:
        o = owners(anchors, kind).select(F.col("key").alias(kind), "n_owners", F.col("owners.entity_id").alias("ids"))
        over = F.coalesce(F.col("n_owners") > MOST, F.lit(False))
        n = F.when(over, 0).otherwise(F.coalesce(F.size(F.filter("ids", lambda i: i != F.col("query_id"))), F.lit(0)))
        out = out.join(o, kind, "left").withColumn(f"{kind}_others", F.greatest(n, F.lit(0))).withColumn(f"{kind}_overflow", over.cast("int")).drop("n_owners", "ids")
    return out.select("query_id", "target_code", *[f"{k}_{x}" for k in KINDS for x in ("others", "overflow")])


def features(pairs: DataFrame, anchors: DataFrame, targets: DataFrame) -> DataFrame:
    """query_id, target_code and NAMES, over all owners of a key. An anchor isn't its own competitor. Owners of a legal name are among those of its core, so the core's are compared for both; equal owners once, and equal questions (a target's values and the anchor) once. Owners of a key are dealt in parts of about MOST; overflow says that there are more than MOST, which are compared all the same."""
    values = ("address", "numbers", "country_key")
    t = targets.select(F.col("code").alias("target_code"), *KINDS, *[F.col(v).alias(f"t_{v}") for v in values])
    base = pairs.select("query_id", "target_code").join(t, "target_code").select("query_id", "target_code", F.struct("query_id", *KINDS, *[f"t_{v}" for v in values]).alias("asked"))
    a = anchors.where("core <> ''").select(F.coalesce("entity_id", F.lit("")).alias("id"), *KINDS, *values)
    alike = a.groupBy(*KINDS, *values).agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    parts = alike.groupBy("core").agg(F.ceil(F.count("*") / MOST).alias("parts"), F.sum("n").alias("n_core"), F.min("low"), F.max("high"))  # all columns, so that the shuffle is owner's too
    owner = alike.join(parts.select("core", "parts"), "core").withColumn("part", F.pmod(F.xxhash64("legal", *values), F.col("parts"))).select("core", "part", F.col("legal").alias("o_legal"), *values, "n", "low", "high")
    each = base.select("asked").distinct().select("asked", "asked.*").join(parts.select("core", "parts", "n_core"), "core").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).join(owner, ["core", "part"])
    other = ~((F.col("low") == F.col("query_id")) & (F.col("high") == F.col("query_id")))
    each = each.withColumn("_f", sim.fuzzy(F.col("t_address"), F.when(other, F.col("address")))).withColumn("_num", F.when(other, F.coalesce(sim.jaccard(F.col("numbers"), F.col("t_numbers")), F.lit(0.0))).otherwise(0.0))
    joint = F.when(other & (F.col("country_key") == F.col("t_country_key")), (F.col("_f.ratio") + F.col("_f.token_sort") + F.col("_num")) / 3).otherwise(0.0)
    compared = dict(zip(FIELDS[2:7], (F.col("_f.ratio"), F.col("_f.token_set"), F.col("_f.token_sort"), F.col("_num"), joint), strict=True))
    same = {"legal": F.col("o_legal") == F.col("legal"), "core": F.lit(True)}
    found = each.groupBy("asked").agg(F.sum(F.when(same["legal"], F.col("n"))).alias("n_legal"), F.max("n_core").alias("n_core"), *[F.max(F.when(same[k], x)).alias(f"{PREFIX[k]}_{f}") for k in KINDS for f, x in compared.items()])
    q = anchors.groupBy(F.col("entity_id").alias("query_id")).agg(F.max("address").alias("q_address"), *[F.collect_list(k).alias(f"q_{k}") for k in KINDS])
    out = base.join(q, "query_id").join(found, "asked", "left").withColumn("_own", sim.token_sort(F.col("q_address"), F.col("asked.t_address")))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    made = {}
    for kind in KINDS:
        mine = F.size(F.filter(f"q_{kind}", lambda x: x == F.col(f"asked.{kind}")))  # noqa: B023
        made |= {f"{PREFIX[kind]}_{f}": zero(F.col(f"{PREFIX[kind]}_{f}")) for f in compared}
        made[f"{PREFIX[kind]}_other_count_log"] = zero(F.log1p(F.col(f"n_{kind}") - mine))
        made[f"{PREFIX[kind]}_overflow"] = zero((F.col(f"n_{kind}") > MOST).cast("double"))
        made[f"{PREFIX[kind]}_address_margin"] = F.col("_own") - made[f"{PREFIX[kind]}_other_address_token_sort"]
    return out.groupBy("query_id", "target_code").agg(*[F.max(made[f]).alias(f) for f in NAMES])
