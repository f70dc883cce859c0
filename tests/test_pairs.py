import math

import pytest
from pyspark.sql import functions as F

from kinweave.functions import similarity as sim
from kinweave.operators import context, features, graph, translate, validate
from kinweave.sources import records

ROWS = [
    ("S1-1", "Acme Private Limited", "12 Rue de Paris 75001", "FR"), ("S1-2", "Acme Ltd", "1 High St", "FR"), ("S1-3", "", "", ""),
    ("S2-1", "ACME Pvt Ltd", "99 Rue de Paris 75001", "FR"), ("S2-2", "Acme Limited", "1 High Street", "FR"), ("S3-1", "Other", "", "US"),
]


def prepared(spark):
    return records.prepare(spark.createDataFrame(ROWS, records.RECORD))


def pairs(spark, *ps):
    return spark.createDataFrame([(a, b) for a, b in ps], "query_id string, target_code long")


def test_feature_counts():
    assert (len(features.BASE), len(features.ADVANCED), len(context.NAMES), len(graph.NAMES), len(translate.FEATURES)) == (71, 41, 16, 65, 12)
    assert len(set(features.BASE + features.ADVANCED + context.NAMES + graph.NAMES)) == 193


def test_base_features(spark):
    p = prepared(spark)
    c = pairs(spark, ("S1-1", 2 * 10**12 + 1), ("S1-3", 3 * 10**12 + 1)).withColumn("mask", F.lit(10))
    for b, s, r in (("name_char", 0, 0), ("name_word", 5 * 10**11, 2), ("address_char", 0, 0)):
        c = c.withColumn(f"score_{b}", F.lit(s).cast("long")).withColumn(f"rank_{b}", F.lit(r)).withColumn(f"actual_{b}_cosine", F.lit(0.25))
    got = {r.query_id: r for r in features.base(features.paired(c, p.where("source = 1"), p.where("source > 1")), 1e12).collect()}
    r = got["S1-1"]
    assert [x for x in r.__fields__ if x not in ("query_id", "target_code")] == list(features.BASE)
    assert (r.name_legal_exact, r.name_exact, r.country_equal, r.address_numbers_overlap, r.address_numbers_disagree, r.address_numbers_conflict) == (1, 0, 1, 1, 1, 0)
    assert (r.retrieval_score, r.retrieval_rank_reciprocal, r.retrieval_name_token, r.retrieval_name_exact, r.left_source1, r.right_source2) == (0.5, 0.5, 1, 1, 1, 1)
    e = got["S1-3"]
    assert (e.name_left_missing, e.name_exact, e.name_edit_similarity, e.address_exact, e.address_right_missing, e.country_conflict) == (1, 0, 0, 0, 1, 0)


def test_advanced_features(spark):
    rows = [("S1-1", "x", "1106 Westmoreland Avenue", ""), ("S2-1", "x", "1113 Westmoreland Ave", ""), ("S2-2", "", "", "")]
    v = features.views(records.prepare(spark.createDataFrame(rows, records.RECORD)))
    got = {r.target_code % 10: r for r in features.advanced(pairs(spark, ("S1-1", 2 * 10**12 + 1), ("S1-1", 2 * 10**12 + 2)), v, v).collect()}
    assert (got[1].address_without_numbers_exact, got[1].address_first_number_equal, got[1].address_best_number_edit) == (1, 0, 0.5)
    assert all(x == 0 for k, x in got[2].asDict().items() if k not in ("query_id", "target_code"))


def test_competing_reference(spark):
    k = context.keys(prepared(spark))
    r = {x.query_id: x for x in context.features(pairs(spark, ("S1-1", 2 * 10**12 + 2), ("S1-2", 2 * 10**12 + 2)), k.where("code < 2000000000000"), k).collect()}
    assert r["S1-2"].reference_name_other_count_log == 0 and r["S1-1"].reference_name_other_count_log > 0
    assert r["S1-1"].reference_name_other_address_token_sort == 1 and 0 > r["S1-1"].reference_name_address_margin


def test_graph_excludes_itself(spark):
    s = spark.createDataFrame([("S1-1", 2 * 10**12 + 1, 0.99), ("S1-1", 2 * 10**12 + 2, 0.5), ("S1-2", 2 * 10**12 + 2, 0.97)], "query_id string, target_code long, score double")
    got = {(r.query_id, r.target_code % 10): r for r in graph.build(s, prepared(spark).where("source > 1"), "frozen_calibration").collect()}
    assert got[("S1-2", 2)].graph_support_count == got[("S1-1", 1)].graph_support_count == 0
    assert got[("S1-1", 2)].graph_support_count == 1 and got[("S1-1", 2)].graph_support_max_country_equal == 1
    many = spark.createDataFrame([("a", 2 * 10**12 + i, 0.96 + i / 1000) for i in range(6)], "query_id string, target_code long, score double")
    assert {r.support_count for r in graph.context(many).collect()} == {3}
    with pytest.raises(ValueError):
        graph.build(s, prepared(spark), "training")


def test_translation(spark):
    rows = [(f"red {x}", f"красный {y}", f"g{i}") for i, (x, y) in enumerate([("fox", "лис"), ("hen", "курица"), ("cat", "кот"), ("dog", "пёс")])]
    lex = {r.foreign: r for r in translate.lexicon(translate.sentences(spark.createDataFrame(rows, "left_name string, right_name string, group_id string"))).collect()}
    assert lex["красный"].english == "red" and lex["красный"].accepted and not lex["лис"].accepted
    once = translate.lexicon(translate.sentences(spark.createDataFrame([("red fox", "красный лис", "g")] * 30, "left_name string, right_name string, group_id string")))
    assert not once.where("accepted").collect()
    found = spark.createDataFrame([("красный", "red", True)], "foreign string, english string, accepted boolean")
    assert translate.translate(spark.createDataFrame([(1, "Красный Лис")], "id int, name string"), found).first().translated == "red лис"


def test_validation(spark):
    a = spark.createDataFrame([("S1-1", "US"), ("S1-2", "FR")], "entity_id string, country string")
    t = spark.createDataFrame([("S2-1",), ("S3-1",)], "entity_id string")
    rows = lambda *r: spark.createDataFrame(list(r), "id string, targets array<string>")
    good = rows(("S1-1", ["S2-1"]), ("S1-2", []))
    assert validate.strict(good, good, a, t).count() == 0
    bad = rows(("S1-1", ["S2-1", "S2-1", "S2-5"]), ("S1-1", []), ("S1-9", ["x"]))
    kinds = {r.kind for r in validate.strict(bad, good, a, t).collect()}
    assert kinds == {"repeated_target", "unknown_target", "repeated_anchor", "unknown_anchor", "target_syntax", "missing_anchor", "missing_by_country", "not_a_candidate"}
    assert {r.severity for r in validate.official(bad, good, a).where("kind = 'not_a_candidate'").collect()} == {"warning"}
    lines = spark.createDataFrame([(0, "source1_entity_id\tmatched"), (1, "S1-1\tS2-1\tx"), (2, "S1-1\t")], "line long, value string")
    assert sorted(r.kind for r in validate.parse(lines, "matching_results")[1].collect()) == ["columns", "header"]


def test_graph_compares_two_targets_once(spark, monkeypatch):
    """However many anchors have them as candidates; anchors with other supports, or none, keep their own values."""
    rows = [("S2-1", "red fox", "1 main road", "US"), ("S2-2", "red fox", "9 main road", "US"), ("S3-3", "blue hen", "1 main road", "FR")]
    t = records.prepare(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"))
    a, b, c = 2 * 10**12 + 1, 2 * 10**12 + 2, 3 * 10**12 + 3
    scored = [(f"S1-{q}", x, 0.99) for q in range(5) for x in (a, b)] + [("S1-8", a, 0.99), ("S1-8", c, 0.99), ("S1-9", a, 0.5), ("S1-9", 7, 0.99)]
    compared, real = [], features.with_views
    monkeypatch.setattr(graph.features, "with_views", lambda p, *x: compared.append(p) or real(p, *x))
    got = {(r.query_id, r.target_code): r for r in graph.comparisons(spark.createDataFrame(scored, "query_id string, target_code long, score double"), t).collect()}
    assert len(got) == len(scored)
    assert sorted((r.target_code, r.support) for r in compared[0].select("target_code", "support").collect()) == [(a, b), (a, c), (b, a), (c, a)]
    for q in range(5):
        r = got[f"S1-{q}", a]
        assert (r.graph_support_max_name_exact, r.graph_support_max_address_exact, r.graph_support_max_country_equal) == (1, 0, 1)
    r = got["S1-8", a]
    assert (r.graph_support_max_name_exact, r.graph_support_max_address_exact, r.graph_support_max_country_equal) == (0, 1, 0)
    assert not any(got["S1-9", x][f"graph_support_max_{y}"] for x in (a, 7) for y in ("name_exact", "address_exact", "country_equal"))


def test_all_competing_references_are_compared(spark):
    """Keys of more than 100 owners too: equal owners, an own id among them, a null id, country and address, and a legal name whose core has more owners, against brute force."""
    rows = [(f"S1-{i}", "acme ltd" if i < 130 else "acme", None if i == 50 else f"{i // 2 if i < 20 else i} {'main high long'.split()[i % 3]} road", None if i == 51 else ("US", "FR")[i % 2]) for i in range(160)]
    rows += [("S1-999", "acme ltd", "7 high road west", "US"), ("S1-900", "fox", "5 hill", "US"), ("S1-901", "fox", "5 hill", "US"), ("S1-902", "", "", "")]
    rows += [(f"S2-{i}", n, x, c) for i, (n, x, c) in enumerate([("acme ltd", "7 high road west", "US"), ("acme", "121 main road", "FR"), ("acme ltd", "", "US"), ("fox", "5 hill", None), ("hen", "5 hill", "US"), ("", "5 hill", "US"), ("acme ltd", "121 main road", "FR")])]
    k = context.keys(records.prepare(spark.createDataFrame(rows, records.RECORD))).withColumn("entity_id", F.expr("nullif(entity_id, 'S1-999')")).cache()
    every = {r.entity_id: r for r in k.where("entity_id is not null").collect()}
    anchors = k.where("entity_id is null or entity_id like 'S1%'")
    owners, ask = anchors.collect(), [(f"S1-{q}", 2 * 10**12 + t) for q in (0, 1, 50, 121, 140, 900, 902) for t in range(7)]
    got = {(r.query_id, r.target_code): r for r in context.features(pairs(spark, *ask), anchors, k.where("entity_id like 'S2%'")).collect()}
    assert len(got) == len(ask)
    for query, code in ask:
        q, t = every[query], every[f"S2-{code % 10}"]
        for kind in context.KINDS:
            of = [o for o in owners if o[kind] and o[kind] == t[kind]]
            rest = [o for o in of if o.entity_id != query]
            x = [(sim.fuzz_ratio(o.address or "", t.address), sim.token_set_ratio(o.address or "", t.address), sim.token_sort_ratio(o.address or "", t.address), len({*(o.numbers or ())} & {*t.numbers}) / max(1, len({*(o.numbers or ())} | {*t.numbers})), o.country_key == t.country_key and t.country_key is not None) for o in rest]
            most = [max((y[i] for y in x), default=0) for i in range(4)]
            want = [math.log1p(len(rest)), float(len(of) > 100), *most, max((y[4] * (y[0] + y[2] + y[3]) / 3 for y in x), default=0), sim.token_sort_ratio(q.address or "", t.address) - most[2]]
            assert [got[query, code][f"{context.PREFIX[kind]}_{f}"] for f in context.FIELDS] == pytest.approx(want), (query, code, kind)
    assert got["S1-0", 2 * 10**12].reference_name_overflow == got["S1-0", 2 * 10**12].reference_name_other_address_ratio == 1
