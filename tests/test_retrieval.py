import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kinweave.operators import candidates as cnd
from kinweave.operators import sampling, search, tfidf

NAMES = ["red fox club", "red fox", "blue fox inn", "red hen", "café de la gare", "gare du nord", "fox", "", "राम stores", "red fox club"]


def docs(spark):
    rows = [(f"S{1 + i % 3}-{i}", 1 + i % 3, i, n, n, "US") for i, n in enumerate(NAMES)]
    return spark.createDataFrame(rows, "entity_id string, source int, num long, name_key string, address_key string, country string").withColumn("code", F.col("source") * F.lit(10**12) + F.col("num"))


def dense(max_df=1.0, min_df=1):
    t = [Counter(n.split()) for n in NAMES]
    df = Counter(w for c in t for w in c)
    n = len(NAMES)
    out = []
    for c in t:
        v = {w: (1 + math.log(k)) * (math.log((1 + n) / (1 + df[w])) + 1) for w, k in c.items() if min_df <= df[w] <= max_df * n}
        s = math.sqrt(sum(x * x for x in v.values()))
        out.append({w: round(x / s * 1e6) for w, x in v.items()})
    return out


def test_top_k_is_brute_force(spark):
    d = docs(spark)
    w = tfidf.weigh(d, tfidf.fit(d, "name_word", 1, 1.0), "name_word")
    got = {(r.query_id, r.source, r["rank"]): (r.num, r.score) for r in tfidf.retrieve(w.where("source = 1"), w.where("source > 1"), 2).collect()}
    v = dense()
    v[8] = {}  # its word characters aren't split at marks by str.split()
    want = {}
    for q in range(0, len(NAMES), 3):
        for s in (2, 3):
            scored = sorted((-sum(x * v[t].get(k, 0) for k, x in v[q].items()), t) for t in range(len(NAMES)) if 1 + t % 3 == s)
            for rank, (m, t) in enumerate([x for x in scored if x[0] < 0][:2], 1):
                want[(f"S1-{q}", s, rank)] = (t, -m)
    assert got == want


def test_plan_limits_groups_before_the_window(spark):
    d = docs(spark)
    w = tfidf.weigh(d, tfidf.fit(d, "name_word", 1, 1.0), "name_word")
    assert "WindowGroupLimit" in tfidf.retrieve(w, w, 2)._jdf.queryExecution().toString()


def test_tokenizers(spark):
    df = spark.createDataFrame([("ab c", "राम")], "a string, b string")
    r = df.select(tfidf.char_grams(F.col("a")), tfidf.word_terms(F.col("b"))).first()
    assert sorted(r[0]) == sorted([" ab", "ab ", " ab ", " c "]) and r[1] == ["र", "म"]


def test_rerank_equals_whole(spark):
    d = docs(spark)
    w = tfidf.weigh(d, tfidf.fit(d, "name_word", 1, 1.0), "name_word")
    q, t = w.where("source = 1"), w.where("source > 1")
    key = lambda df: sorted((r.query_id, r.num, r.score) for r in df.collect())
    assert key(tfidf.retrieve(q, t, 3, query_terms=5, pool=100)) == key(tfidf.retrieve(q, t, 3))
    with pytest.raises(ValueError):
        tfidf.retrieve(q, t, 3, pool=5)


def test_exact_cap_and_union(spark):
    q = spark.createDataFrame([("S1-1", "acme", "1 road"), ("S1-2", "", "road")], "entity_id string, name_key string, address_key string")
    t = spark.createDataFrame([(f"S{s}-{i}", s * 10**12 + i, "acme", "1 road" if i == 1 else "road") for s in (2, 3) for i in (1, 2)] + [("S2-9", 2 * 10**12 + 9, "", "")], "entity_id string, code long, name_key string, address_key string")
    every = cnd.exact(q, t)
    assert sorted((r.query_id, r.target_code % 10**12, r["mask"]) for r in every.collect()) == [("S1-1", 1, 24), ("S1-1", 1, 24), ("S1-1", 2, 8), ("S1-1", 2, 8)]
    assert sorted(r.target_code for r in cnd.capped(every, 2).collect()) == [2 * 10**12 + 1, 2 * 10**12 + 2]
    assert tuple(cnd.overflow(every, 2).first()) == (4, 2, 2, 1)
    sparse = spark.createDataFrame([("S1-1", 2 * 10**12 + 1, 5, 1), ("S1-2", 2 * 10**12 + 2, 7, 1)], "query_id string, target_code long, score long, rank int")
    u = {(r.query_id, r.target_code): (r["mask"], r.score_name_word, r.rank_name_word) for r in cnd.union({"name_word": sparse}, cnd.capped(every, 2)).collect()}
    assert u == {("S1-1", 2 * 10**12 + 1): (26, 5, 1), ("S1-1", 2 * 10**12 + 2): (8, 0, 0), ("S1-2", 2 * 10**12 + 2): (2, 7, 1)}


def test_recall_ceiling(spark):
    a = spark.createDataFrame([("S1-1", "US"), ("S1-2", "FR")], "entity_id string, country string")
    truth = spark.createDataFrame([("S1-1", 1), ("S1-1", 2), ("S1-1", 3)], "s1_id string, target_code long")
    c = spark.createDataFrame([("S1-1", 1, 1), ("S1-1", 2, 2)], "query_id string, target_code long, mask int")
    r = cnd.recall(cnd.found(a, truth, c)).first()
    assert abs(r.f05_ceiling - (2.5 / 2.75 + 1) / 2) < 1e-12 and abs(r.link_recall - 2 / 3) < 1e-12


def test_split_keeps_links_together(spark):
    rec = spark.createDataFrame([(f"S{s}-{i}", s) for s in (1, 2, 3) for i in range(60)], "entity_id string, source int")
    links = spark.createDataFrame([(f"S1-{i}", f"S{2 + i % 2}-{i}") for i in range(0, 60, 2)], "s1_id string, target_id string")
    s = sampling.split(rec, links)
    sampling.check_split(s, links)
    assert {r[0]: r[1] for r in s.repartition(7).select("entity_id", "split").collect()} == {r[0]: r[1] for r in s.select("entity_id", "split").collect()}
    st = {r.split: r for r in sampling.split_stats(s, links).collect()}
    assert sum(r.n_anchors for r in st.values()) == 60 and sum(r.n_links for r in st.values()) == 30
    assert [r[0] for r in sampling.bottom_hash(rec, 5).collect()] == [r[0] for r in sampling.bottom_hash(rec.repartition(5), 5).collect()]
    with pytest.raises(ValueError):
        sampling.refuse_held_out("validation_split")


def plan(df):
    return df._jdf.queryExecution().toString()


def test_search_in_shards_is_brute_force(spark, monkeypatch):
    """Many equal and tied vectors, several shards of each source, lists read in part."""
    monkeypatch.setattr(tfidf, "SHARD", 300)
    monkeypatch.setattr(search, "FIRST", 4)
    rng = random.Random(5)
    names = [" ".join(rng.sample([f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(12)], rng.choice([1, 2, 3, 7]))) for _ in range(150)]
    rows = [(f"S{1 + i % 3}-{i}", 1 + i % 3, i, n, n) for i, n in enumerate(rng.choices(names, k=600))]
    d = spark.createDataFrame(rows, "entity_id string, source int, num long, name_key string, address_key string")
    w = tfidf.weigh(d, tfidf.fit(d, "name_word", 2, 0.5), "name_word")
    v, least = {}, {}
    for r in w.collect():
        v.setdefault((r.source, r.num), {})[r.term] = r.w
    for r in tfidf.prune(w, 2).collect():
        least.setdefault((r.source, r.num), {})[r.term] = r.w
    dot = lambda a, b: sum(x * b.get(t, 0) for t, x in a.items())
    for few, pool in ((None, None), (2, None), (2, 9)):
        want = {}
        for q in (q for q in v if q[0] == 1):
            for s in (2, 3):
                scored = sorted((-x, t[1]) for t in v if t[0] == s and (x := dot((least if few else v)[q], v[t])))[: pool or 4]
                if pool:
                    scored = sorted((-dot(v[q], v[(s, n)]), n) for _, n in scored)[:4]
                for rank, (x, n) in enumerate(scored, 1):
                    want[(f"S1-{q[1]}", s, rank)] = (n, f"S{s}-{n}", -x)
        got = tfidf.retrieve(w.where("source = 1"), w.where("source > 1"), 4, few, pool)
        assert {(r.query_id, r.source, r["rank"]): (r.num, r.target_id, r.score) for r in got.collect()} == want


def test_retrieval_moves_no_pairs(spark):
    """Neither search nor rescoring joins weights by term."""
    d = docs(spark)
    w = tfidf.weigh(d, tfidf.fit(d, "name_word", 1, 1.0), "name_word")
    q, t = w.where("source = 1"), w.where("source > 1")
    assert "wq" not in plan(tfidf.retrieve(q, t, 2)) and "wq" not in plan(tfidf.rerank(tfidf.retrieve(q, t, 2), q, t))


def test_exact_joins_of_copies_are_capped_before_they_grow(spark):
    q = spark.range(40).selectExpr("concat('S1-', id) as entity_id", "'acme' as name_key", "if(id < 20, '1 road', '2 road') as address_key")
    t = spark.range(50).selectExpr("2000000000000 + id div 2 as code", "if(id < 45, 'acme', 'x') as name_key", "if(id > 2, '1 road', '2 road') as address_key")
    rows = lambda df: sorted((r.query_id, r.target_code, r["mask"]) for r in df.collect())
    few = cnd.exact(q, t, 3)
    assert few.count() <= 40 * 6 and rows(cnd.capped(few, 3)) == rows(cnd.capped(cnd.exact(q, t), 3)) and cnd.exact(q, t).count() == 960


def test_exact_among_pairs_is_the_exact_join_without_a_cap(spark):
    """Of the given pairs those that the joins give, each once; null and empty keys, repeated ids and unknown ones."""
    q = spark.createDataFrame([("S1-1", "acme", "1 road"), ("S1-2", "", "2 road"), ("S1-3", None, "road"), ("S1-4", "acme", None), ("S1-4", "fox", "1 road")], "entity_id string, name_key string, address_key string")
    t = spark.createDataFrame([(1, "acme", "1 road"), (2, "acme", "road"), (3, "", "2 road"), (4, None, "road"), (5, "fox", None), (5, "fox", "1 road")], "code long, name_key string, address_key string")
    every = q.select(F.col("entity_id").alias("query_id")).crossJoin(t.select(F.col("code").alias("target_code")))
    some = every.where("target_code % 2 = 1").unionByName(spark.createDataFrame([("S1-9", 1), ("S1-1", 9)], "query_id string, target_code long"))
    rows = lambda df: sorted((r.query_id, r.target_code, r["mask"]) for r in df.collect())
    assert rows(cnd.exact_among(every, q, t)) == rows(cnd.exact(q, t))
    assert rows(cnd.exact_among(some, q, t)) == [r for r in rows(cnd.exact(q, t)) if r[1] % 2 == 1]
