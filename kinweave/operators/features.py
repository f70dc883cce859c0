"""Pair features. The order of the names is part of the contract of the models.

Pairs carry `left` and `right`, structs of prepared records, so that texts are
normalised once for each entity and never for each pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text
from .candidates import BITS

# The names of the columns, in order.
TEXT = ("exact", "folded_exact", "token_jaccard", "token_containment", "token_overlap", "length_ratio", "token_count_ratio", "edit_similarity", "token_sort_similarity", "numbers_both_present", "numbers_equal", "numbers_overlap", "numbers_conflict", "numbers_disagree", "numbers_jaccard", "left_missing", "right_missing")
LEGAL = ("name_legal_exact", "name_core_exact", "name_acronym_exact", "name_acronym_matches_name")
COUNTRY = ("country_equal", "country_conflict", "country_left_missing", "country_right_missing")
SOURCE = ("left_source1", "right_source2", "right_source3")
RETRIEVAL = ("retrieval_rank_reciprocal", "retrieval_score", "retrieval_candidate_count_log1p", "retrieval_name_rank_reciprocal", "retrieval_address_rank_reciprocal", "retrieval_name_score", "retrieval_address_score")
PROVENANCE = ("name_exact", "address_exact", "name_char", "address_char", "name_token", "address_token", "number_block", "sorted_neighborhood")
CHANNELS = ("name_char", "name_word", "address_char", "address_word")
COSINES = ("actual_name_char_cosine", "actual_name_word_cosine", "actual_address_char_cosine")
BASE = (*(f"{f}_{x}" for f in ("name", "address") for x in TEXT), *LEGAL, *COUNTRY, *SOURCE, *RETRIEVAL, *(f"retrieval_{p}" for p in PROVENANCE), *(f"retrieval_{c}_{x}" for c in CHANNELS for x in ("score", "rank_reciprocal")), *COSINES)
VIEWS = ("roman_edit", "roman_jaro", "roman_ratio", "roman_partial", "roman_token_set", "roman_token_sort", "alternate_edit", "alternate_token_set", "alternate_token_sort", "without_numbers_exact", "without_numbers_token_set", "first_number_equal", "last_number_equal", "first_number_edit", "best_number_edit", "short_numbers_jaccard", "long_numbers_jaccard", "number_count_ratio", "first_number_length_ratio")
ADVANCED = (*(f"{f}_{x}" for f in ("name", "address") for x in VIEWS), "roman_name_char_cosine", "roman_name_word_cosine", "roman_address_char_cosine")


def text_features(a: Column, b: Column) -> dict[str, Column]:
    """The 17 columns of one field; a and b are its prepared structs."""
    x, y = a["normalized"], b["normalized"]
    n = sim.numbers(a["numbers"], b["numbers"])
    return {
        "exact": sim.equal(x, y), "folded_exact": sim.equal(a["folded"], b["folded"]),
        "token_jaccard": sim.jaccard(a["tokens"], b["tokens"]), "token_containment": sim.containment(a["tokens"], b["tokens"]), "token_overlap": sim.overlap(a["tokens"], b["tokens"]),
        "length_ratio": sim.ratio(F.length(x), F.length(y)), "token_count_ratio": sim.ratio(F.size(a["tokens"]), F.size(b["tokens"])),
        "edit_similarity": sim.edit_similarity(x, y), "token_sort_similarity": sim.edit_similarity(a["sorted_tokens"], b["sorted_tokens"]),
        **{f"numbers_{k}": v for k, v in n.items()}, "left_missing": (x == "").cast("int"), "right_missing": (y == "").cast("int"),
    }


def record_features(a: Column, b: Column) -> dict[str, Column]:
    """Text, legal, country and source columns of two prepared records."""
    out = {f"{f}_{k}": v for f in ("name", "address") for k, v in text_features(a[f], b[f]).items()}
    x, y, p, q = a["name"], b["name"], a["country_key"], b["country_key"]
    out |= {"name_legal_exact": sim.equal(x["legal"], y["legal"]), "name_core_exact": sim.equal(x["core"], y["core"]), "name_acronym_exact": ((F.length(x["acronym"]) > 1) & (x["acronym"] == y["acronym"])).cast("int"), "name_acronym_matches_name": sim.acronym_matches(x["acronym"], x["normalized"], y["acronym"], y["normalized"])}
    out |= {"country_equal": sim.equal(p, q), "country_conflict": ((p != "") & (q != "") & (p != q)).cast("int"), "country_left_missing": (p == "").cast("int"), "country_right_missing": (q == "").cast("int")}
    return out | {"left_source1": (a["source"] == 1).cast("int"), "right_source2": (b["source"] == 2).cast("int"), "right_source3": (b["source"] == 3).cast("int")}


def retrieval_features(scale: float) -> dict[str, Column]:
    """From score_*, rank_* and mask of candidates with candidate_count; scores are divided by scale."""
    c = F.col
    score = {b: c(f"score_{b}") / scale for b in ("name_char", "name_word", "address_char")}
    back = lambda r: F.when(r < 1, 0.0).otherwise(1 / r)
    least = lambda *bs: F.coalesce(F.array_min(F.filter(F.array(*[c(f"rank_{b}") for b in bs]), lambda r: r > 0)), F.lit(0))
    out = {
        "retrieval_rank_reciprocal": back(least("name_char", "name_word", "address_char")), "retrieval_score": F.greatest(*score.values()), "retrieval_candidate_count_log1p": F.log1p("candidate_count"),
        "retrieval_name_rank_reciprocal": back(least("name_char", "name_word")), "retrieval_address_rank_reciprocal": back(c("rank_address_char")), "retrieval_name_score": F.greatest(score["name_char"], score["name_word"]), "retrieval_address_score": score["address_char"],
    }
    bit = {"name_exact": "name_exact", "name_char": "name_char", "address_char": "address_char", "name_token": "name_word", "number_block": "number_block"}
    out |= {f"retrieval_{p}": (c("mask").bitwiseAND(BITS[bit[p]]) != 0).cast("int") if p in bit else F.lit(0) for p in PROVENANCE}
    for ch in CHANNELS:
        out |= {f"retrieval_{ch}_score": score.get(ch, F.lit(0.0)), f"retrieval_{ch}_rank_reciprocal": back(c(f"rank_{ch}")) if ch in score else F.lit(0.0)}
    return out


def paired(candidates: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """candidates with left and right structs and candidate_count. left: prepared anchors; right: prepared targets."""
    n = F.count("*").over(Window.partitionBy("query_id")).alias("candidate_count")
    a = left.select(F.col("entity_id").alias("query_id"), F.struct(*left.columns).alias("left"))
    b = right.select(F.col("code").alias("target_code"), F.struct(*right.columns).alias("right"))
    return candidates.select("*", n).join(a, "query_id").join(b, "target_code")


def base(pairs: DataFrame, scale: float) -> DataFrame:
    """The base columns in order, beside query_id, target_code and label if there. pairs: paired() with the three cosines."""
    every = record_features(F.col("left"), F.col("right")) | retrieval_features(scale) | {c: F.col(c) for c in COSINES}
    keys = [k for k in ("query_id", "target_code", "label") if k in pairs.columns]
    return pairs.select(*keys, *[every[name].cast("double").alias(name) for name in BASE])


def number_features(x: Column, y: Column) -> dict[str, Column]:
    """From two ordered arrays of numbers; all 0 unless both have some."""
    both = (F.size(x) > 0) & (F.size(y) > 0)
    at = lambda a, i: F.try_element_at(a, F.lit(i))
    short = lambda a: F.array_distinct(F.filter(a, lambda t: F.length(t) <= 4))
    long = lambda a: F.array_distinct(F.filter(a, lambda t: F.length(t) >= 5))
    every = {
        "first_number_equal": (at(x, 1) == at(y, 1)).cast("int"), "last_number_equal": (at(x, -1) == at(y, -1)).cast("int"), "first_number_edit": sim.edit_similarity(at(x, 1), at(y, 1)),
        "best_number_edit": F.array_max(F.flatten(F.transform(x, lambda a: F.transform(y, lambda b: sim.edit_similarity(a, b))))),
        "short_numbers_jaccard": sim.jaccard(short(x), short(y)), "long_numbers_jaccard": sim.jaccard(long(x), long(y)),
        "number_count_ratio": sim.ratio(F.size(x), F.size(y)), "first_number_length_ratio": sim.ratio(F.length(at(x, 1)), F.length(at(y, 1))),
    }
    return {k: F.when(both, v).otherwise(0).cast("double") for k, v in every.items()}


def views(prepared: DataFrame) -> DataFrame:
    """entity_id, code, name_roman, name_view, address_roman, address_view: once for each entity."""
    df = prepared.select("entity_id", "code", F.col("name.normalized").alias("_n"), F.col("address.normalized").alias("_a"))
    df = text.romanize(text.romanize(df, "_n", "name_roman"), "_a", "address_roman")
    return df.withColumn("name_view", text.alternate_view(F.col("name_roman"))).withColumn("address_view", text.alternate_view(F.col("address_roman"))).drop("_n", "_a")


def view_features(a: Column, b: Column, x: Column, y: Column) -> dict[str, Column]:
    """The 19 columns of one field: romanised texts a and b, alternate views x and y."""
    return {
        "roman_edit": sim.edit_similarity(a, b), "roman_jaro": sim.jaro(a, b), "roman_ratio": sim.indel(a, b), "roman_partial": sim.partial(a, b), "roman_token_set": sim.token_set(a, b), "roman_token_sort": sim.token_sort(a, b),
        "alternate_edit": sim.edit_similarity(x["text"], y["text"]), "alternate_token_set": sim.token_set(x["text"], y["text"]), "alternate_token_sort": sim.token_sort(x["text"], y["text"]),
        "without_numbers_exact": sim.equal(x["without_numbers"], y["without_numbers"]), "without_numbers_token_set": sim.token_set(x["without_numbers"], y["without_numbers"]),
        **number_features(x["numbers"], y["numbers"]),
    }


VIEW_COLUMNS = ("name_roman", "name_view", "address_roman", "address_view")


def with_views(pairs: DataFrame, left: DataFrame, right: DataFrame, on: tuple[str, str], by: tuple[str, str]) -> DataFrame:
    """pairs with l_* and r_* columns of views(): pairs' columns `on` are joined to the columns `by`."""
    for df, key, col, side in ((left, by[0], on[0], "l"), (right, by[1], on[1], "r")):
        pairs = pairs.join(df.select(F.col(key).alias(col), *[F.col(c).alias(f"{side}_{c}") for c in VIEW_COLUMNS]), col)
    return pairs


def view_columns() -> dict[str, Column]:
    c = F.col
    return {f"{f}_{k}": v for f in ("name", "address") for k, v in view_features(c(f"l_{f}_roman"), c(f"r_{f}_roman"), c(f"l_{f}_view"), c(f"r_{f}_view")).items()}


def advanced(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """query_id, target_code and the columns of ADVANCED that compare views. left, right: views()."""
    p = with_views(pairs.select("query_id", "target_code"), left, right, ("query_id", "target_code"), ("entity_id", "code"))
    out = view_columns()
    return p.select("query_id", "target_code", *[out[n].cast("double").alias(n) for n in ADVANCED if n in out])


def summarize_positive(features: DataFrame) -> DataFrame:
    """name, n, mean, share (of values that aren't 0) of each base column over positive pairs."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("v")) for c in BASE]))
    return features.where("label = 1").select(each.alias("x")).groupBy("x.name").agg(F.count("*").alias("n"), F.avg("x.v").alias("mean"), (F.count_if(F.col("x.v") != 0) / F.count("*")).alias("share"))
